"""Feature tables as closed validity intervals, bucketed by entity.

A row holds for valid_from <= t < valid_to; the newest version of an entity has valid_to = null (open). The table is stored
in buckets of entity_id, one partition per ingest: ``open`` has the open versions, every other one the versions that this
ingest closed. An ingest newer than all before joins its rows to the open versions only, bucket by bucket, writes its own
partition and then replaces ``open``; older history isn't read. An ingest that failed between the two is repeated with the
same feature time. An ingest at or before the newest feature time (late, or again) takes the place of the rows of its time and has all
intervals derived anew; all versions are written aside first, but a failure while it replaces the partitions leaves the table
incomplete, to be filled from that written copy. One writer at a time, and no lookup during an ingest, is assumed.

A lookup is an equi-join on the entity with the interval as a further condition. The table's side is read in its buckets
and needs no shuffle; only the distinct (entity, time) keys move. Without ``start_time`` no window, sort or range join of
versions is made.

Edge cases: of several rows of an entity with one feature time one stays (the largest hash of its values); null entities are
dropped, since a key of a lookup that is null finds nothing; an empty ingest changes nothing, unless it
replaces its feature time's rows; an entity or a time without version finds nulls.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trustfeed.operators.features import ENTITY, FEATURE_TIME
from trustfeed.session import materialize, scratch_path

FROM, TO, INGEST, OPEN = "valid_from", "valid_to", "ingest", "open"
BUCKETS = 16


class FeatureIntervals:
    """A feature table of closed intervals in the session's catalog, stored below ``path``."""

    def __init__(self, spark: SparkSession, features: list, name: str | None = None, path: str | None = None,
                 buckets: int = BUCKETS):
        """``features``: the StructFields of the features. ``buckets`` should follow the table's size."""
        self.spark, self.names = spark, [f.name for f in features]
        self.table = name or f"feature_intervals_{uuid.uuid4().hex[:12]}"
        if not spark.catalog.tableExists(self.table):
            ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in features)
            where = path or scratch_path(spark, "intervals")
            spark.sql(f"""CREATE TABLE {self.table} ({ENTITY} string, {FROM} timestamp, {TO} timestamp, {ddl}, {INGEST} string)
                USING parquet PARTITIONED BY ({INGEST}) CLUSTERED BY ({ENTITY}) SORTED BY ({ENTITY}) INTO {buckets} BUCKETS
                LOCATION '{where}'""")

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def _one_each(self, df: DataFrame) -> DataFrame:
        """One row per entity and feature time."""
        row = F.struct(*[F.col(f"`{c}`") for c in self.names])
        best = df.where(F.col(ENTITY).isNotNull()).groupBy(F.col(ENTITY).cast("string").alias(ENTITY), F.col(FROM)) \
            .agg(F.max_by(row, F.xxhash64(row)).alias("row"))
        return best.select(ENTITY, FROM, *[F.col(f"row.`{c}`").alias(c) for c in self.names])

    def ingest(self, features: DataFrame, feature_time) -> None:
        """The features as they hold from ``feature_time`` on: (entity_id, feature_time, features ...)."""
        at = F.lit(feature_time).cast("timestamp")
        new = self._one_each(features.withColumn(FROM, at))
        stored = self.rows()
        # the newest version of an entity is open, so the newest of all is
        newer = stored.where(F.col(INGEST) == OPEN).agg(F.coalesce(F.max(FROM) < at, F.lit(True))).first()[0]
        if newer:
            written = self._close_open(materialize(new, "interval-ingest"), stored.where(F.col(INGEST) == OPEN), at)
            self._replace(written.where(F.col(INGEST) != OPEN))
            self._replace(written.where(F.col(INGEST) == OPEN))
        else:
            versions = stored.where(F.col(FROM) != at).select(*new.columns).unionByName(new)
            written = self._derive(self._one_each(versions))
            self._replace(written)
            self._empty_partitions(written)

    def _close_open(self, new: DataFrame, held: DataFrame, at) -> DataFrame:
        """The open versions after the ingest, and those that it closes."""
        closed_by = F.date_format(at, "yyyyMMddHHmmss.SSSSSS")
        mine = new.select(F.col(ENTITY).alias("_tf_new"), F.lit(True).alias("_tf_closed"))
        marked = held.join(mine, F.col(ENTITY) == F.col("_tf_new"), "left")
        kept = marked.select(ENTITY, FROM, F.when(F.col("_tf_closed"), at).alias(TO), *self.names,
                             F.when(F.col("_tf_closed"), closed_by).otherwise(F.lit(OPEN)).alias(INGEST))
        return materialize(kept.unionByName(new.withColumns({TO: F.lit(None).cast("timestamp"), INGEST: F.lit(OPEN)})), "intervals")

    def _derive(self, versions: DataFrame) -> DataFrame:
        """All intervals from the versions; an entity has one row per feature time."""
        after = F.lead(FROM).over(Window.partitionBy(ENTITY).orderBy(FROM))
        label = F.coalesce(F.date_format(TO, "yyyyMMddHHmmss.SSSSSS"), F.lit(OPEN))
        return materialize(versions.withColumn(TO, after).withColumn(INGEST, label), "intervals")

    def _empty_partitions(self, written: DataFrame) -> None:
        """Partitions that get no rows any more (their feature time has lost all its rows) go."""
        left = {r[0] for r in written.select(INGEST).distinct().collect()}      # one row per ingest
        for spec in (r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()):
            if spec.split("=", 1)[1] not in left:
                self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION ({INGEST}='{spec.split('=', 1)[1]}')")

    def _replace(self, written: DataFrame) -> None:
        columns = [ENTITY, FROM, TO, *self.names, INGEST]
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:        # one task and file per partition and bucket
            written.select(*columns).repartition(INGEST, ENTITY).write.mode("overwrite").insertInto(self.table)
        finally:
            self.spark.conf.set(mode, before)

    def versions_at(self, keys: DataFrame, start_time=None) -> DataFrame:
        """For distinct keys (_tf_e, _tf_t) the version that holds; the table's side is not shuffled."""
        table = self.rows()
        holds = (F.col(FROM) <= F.col("_tf_t")) & (F.col(TO).isNull() | (F.col("_tf_t") < F.col(TO)))
        if start_time is not None:
            table = table.where(F.col(FROM) >= F.lit(start_time).cast("timestamp"))
        return keys.join(table, (F.col("_tf_e") == F.col(ENTITY)) & holds).select("_tf_e", "_tf_t", *self.names)

    def lookup(self, instances: DataFrame, column: str, ts_col: str = "timestamp", start_time=None) -> DataFrame:
        """The instances with the features of the entity in ``column`` at their time; none older than ``start_time``."""
        keys = instances.select(F.col(column).cast("string").alias("_tf_e"), F.col(ts_col).cast("timestamp").alias("_tf_t")) \
            .where(F.col("_tf_e").isNotNull() & F.col("_tf_t").isNotNull()).distinct()
        found = self.versions_at(keys, start_time)
        found = materialize(found, "interval-lookup")
        return instances.join(found, (instances[column].cast("string") == found["_tf_e"])
                              & (instances[ts_col].cast("timestamp") == found["_tf_t"]), "left").drop("_tf_e", "_tf_t")

    def at(self, time) -> DataFrame:
        """The version of every entity that holds at one time: a filter, nothing is shuffled."""
        t = F.lit(time).cast("timestamp")
        return self.rows().where((F.col(FROM) <= t) & (F.col(TO).isNull() | (t < F.col(TO)))).select(ENTITY, *self.names)

    def drop(self) -> None:
        """Take the table out of the catalog; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
