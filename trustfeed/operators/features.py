"""Time-stamped feature tables and point-in-time lookup.

A feature table is a plain DataFrame ``(entity_id, feature_time, f1, f2, ...)``
stored as Parquet, one directory per feature time.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trustfeed import schemas
from trustfeed.session import materialize

ENTITY = "entity_id"
FEATURE_TIME = "feature_time"
# Length of the time pieces in which the as-of lookup works.
BUCKET_SECONDS = 86400

# Feature ids of the two entity types (value types in schemas.py).
POST_FEATURES = [f for f in schemas.POST_FEATURES.fieldNames() if f != "recommend"]
PROFILE_FEATURES = ["followship_rank", "followship_score"]


def ingest_features(df: DataFrame, entity_id_field: str, feature_time, feature_ids: list[str],
                    source_fields: dict | None = None) -> DataFrame:
    """One feature row per entity at ``feature_time``.

    ``source_fields`` maps a feature id to the source column it is read from
    (default: the column of the same name).
    """
    src = source_fields or {}
    return df.select(
        F.col(entity_id_field).alias(ENTITY),
        F.lit(feature_time).cast("timestamp").alias(FEATURE_TIME),
        *[F.col(src.get(f, f)).alias(f) for f in feature_ids],
    )


def write_feature_table(features: DataFrame, path: str, feature_time) -> None:
    """One directory per feature time; writing a feature time again replaces it (older ingests untouched)."""
    key = re.sub(r"[^0-9A-Za-z]+", "", str(feature_time))
    features.write.mode("overwrite").option("partitionOverwriteMode", "static") \
        .parquet(f"{path.rstrip('/')}/ingest=t{key}")


def read_feature_table(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("ingest")


def _feature_cols(features: DataFrame) -> list[str]:
    return [c for c in features.columns if c not in (ENTITY, FEATURE_TIME)]


def _when(df: DataFrame):
    """Order of versions: feature time, then a hash of the row, so equal times have one winner."""
    return F.struct(F.col(FEATURE_TIME), F.xxhash64(*[F.col(c) for c in _feature_cols(df)]))


def _newest(features_df: DataFrame, cols: list[str], per_feature: bool):
    t = _when(features_df)
    if per_feature:
        # newest non-NULL value of each feature: max_by skips NULL orderings
        return [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), t)).alias(c) for c in cols]
    return [F.max_by(F.struct(*[F.col(c) for c in cols]), t).alias("_tf_row")]


def _expand(df: DataFrame, cols: list[str], per_feature: bool) -> DataFrame:
    if per_feature:
        return df
    keep = [c for c in df.columns if c != "_tf_row"]
    return df.select(*keep, *[F.col(f"_tf_row.{c}").alias(c) for c in cols])


def latest_features(features: DataFrame, as_of, start_time=None, per_feature: bool = False) -> DataFrame:
    """Newest feature row per entity with start_time <= feature_time <= as_of.

    One grouped ``max_by`` (partial aggregation before the shuffle): a hot
    entity still sends one row per map task.
    """
    cols = _feature_cols(features)
    f = features.where(F.col(FEATURE_TIME) <= F.lit(as_of).cast("timestamp"))
    if start_time is not None:
        f = f.where(F.col(FEATURE_TIME) >= F.lit(start_time).cast("timestamp"))
    agg = f.groupBy(ENTITY).agg(*_newest(f, cols, per_feature))
    return _expand(agg, cols, per_feature)


def point_in_time(instances: DataFrame, lookups: list[tuple[str, DataFrame, str]],
                  timestamp, start_time=None, per_feature: bool = False) -> DataFrame:
    """A12/C12 when every instance carries the same ``timestamp``.

    ``lookups``: (instance column, feature table, prefix for clashing names).
    Each feature table is first reduced to its newest row per entity as of
    ``timestamp``, written once, and then equi-joined (left) to the
    instances: broadcast when small, otherwise a shuffle join whose hot
    entities (an author with a third of the posts) AQE can split.
    """
    out = instances
    for inst_col, table, _ in lookups:
        latest = materialize(latest_features(table, timestamp, start_time, per_feature), "latest-features")
        latest = latest.withColumnRenamed(ENTITY, f"_tf_{inst_col}").drop(FEATURE_TIME)
        out = out.join(latest, out[inst_col] == latest[f"_tf_{inst_col}"], "left").drop(f"_tf_{inst_col}")
    return out


def asof_versions(keys: DataFrame, features: DataFrame, per_feature: bool = False,
                  bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """For distinct keys (_tf_e, _tf_t): the newest version of entity _tf_e at time _tf_t (as-of).

    Keys and versions are put into one stream and cut into (entity, time bucket)
    pieces. Within a piece the last version is carried forward over the keys; what
    came before the piece is carried over a table with one row per entity and
    bucket. Work is linear in keys + versions and a hot entity is spread over its
    buckets; no join has a range condition.
    """
    cols = _feature_cols(features)
    bucket = F.floor(F.unix_seconds(F.col("_tf_t").cast("timestamp")) / bucket_seconds).alias("_tf_b")
    row = F.struct(*[F.col(c) for c in cols])
    values = {c: F.col(c) for c in cols} if per_feature else {"_tf_row": row}
    versions = features.select(F.col(ENTITY).alias("_tf_e"), F.col(FEATURE_TIME).alias("_tf_t"),
                               F.xxhash64(*[F.col(c) for c in cols]).alias("_tf_o"), F.lit(False).alias("_tf_k"),
                               *[v.alias(n) for n, v in values.items()])
    asked = keys.select("_tf_e", "_tf_t", F.lit(None).cast("bigint").alias("_tf_o"), F.lit(True).alias("_tf_k"),
                        *[F.lit(None).cast(versions.schema[n].dataType).alias(n) for n in values])
    stream = versions.unionByName(asked).select("*", bucket)
    # a version at a key's own time counts for it: versions sort before keys
    piece = Window.partitionBy("_tf_e", "_tf_b").orderBy("_tf_t", "_tf_k", "_tf_o")
    order = piece.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = stream.select("_tf_e", "_tf_b", "_tf_t", "_tf_k", F.lead(F.lit(True)).over(piece).isNull().alias("_tf_end"),
                        F.max("_tf_k").over(order).alias("_tf_asked"),
                        *[F.last(n, ignorenulls=True).over(order).alias(n) for n in values])
    # keys, and the last row of each piece, from one pass over the pieces
    run = materialize(run.where(F.col("_tf_k") | F.col("_tf_end")), "asof-run")
    inside = run.where("_tf_k").select("_tf_e", "_tf_b", "_tf_t", *values)
    # the last value of each piece, carried over the earlier pieces of the entity
    ends = run.where("_tf_end").select("_tf_e", "_tf_b", "_tf_asked", *values)
    earlier = Window.partitionBy("_tf_e").orderBy("_tf_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col("_tf_e").alias("_tf_ce"), F.col("_tf_b").alias("_tf_cb"), "_tf_asked",
                          *[F.last(n, ignorenulls=True).over(earlier).alias(f"_tf_c_{n}") for n in values])
    # only pieces with a key, and with something to carry to it, are written and joined
    some = reduce(or_, [F.col(f"_tf_c_{n}").isNotNull() for n in values], F.lit(False))
    carried = materialize(carried.where(F.col("_tf_asked") & some).drop("_tf_asked"), "asof-carried")
    both = inside.join(carried, (F.col("_tf_e") == F.col("_tf_ce")) & (F.col("_tf_b") == F.col("_tf_cb")), "left")
    found = both.select("_tf_e", "_tf_t", *[F.coalesce(n, f"_tf_c_{n}").alias(n) for n in values])
    return _expand(found, cols, per_feature)


def point_in_time_asof(instances: DataFrame, lookups: list[tuple[str, DataFrame, str]],
                       ts_col: str = "timestamp", start_time=None, per_feature: bool = False) -> DataFrame:
    """A12/C12 with a timestamp per instance (general as-of join).

    Distinct (entity, timestamp) keys get their version by ``asof_versions``; the
    per-key result is written once and equi-joined back to the instances
    (broadcast when small, otherwise a shuffle join AQE can split for hot
    entities).
    """
    out = instances
    for inst_col, table, _ in lookups:
        f = table if start_time is None else \
            table.where(F.col(FEATURE_TIME) >= F.lit(start_time).cast("timestamp"))
        keys = instances.select(F.col(inst_col).alias("_tf_e"), F.col(ts_col).alias("_tf_t")) \
            .where(F.col("_tf_e").isNotNull() & F.col("_tf_t").isNotNull()).distinct()
        best = materialize(asof_versions(keys, f, per_feature), "asof-features")
        out = out.join(best, (out[inst_col] == best["_tf_e"]) & (out[ts_col] == best["_tf_t"]), "left") \
            .drop("_tf_e", "_tf_t")
    return out
