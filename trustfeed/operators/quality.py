"""Data-quality reports.

All reports are single-pass aggregations; only their (small) results would
ever be shown on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def value_counts(df: DataFrame, col: str, name: str = "count", keep_null: bool = False) -> DataFrame:
    """D3: rows per value of ``col`` (NULL group dropped unless ``keep_null``)."""
    src = df if keep_null else df.where(F.col(col).isNotNull())
    return src.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def rank_range(df: DataFrame, col: str = "followship_rank") -> DataFrame:
    """Min, max, NULL count and row count in one pass."""
    return df.agg(
        F.min(col).alias("min_rank"),
        F.max(col).alias("max_rank"),
        F.count(F.when(F.col(col).isNull(), 1)).alias("null_ranks"),
        F.count(F.lit(1)).alias("rows"),
    )


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column with its type name, non-NULL count and row count.

    One aggregation computes every count; the wide row is unpivoted with
    ``stack``.
    """
    cols = df.columns
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count(F.col(c)).alias(f"_c{i}") for i, c in enumerate(cols)])
    stack_args = ", ".join(f"'{c}', {i}, _c{i}" for i, c in enumerate(cols))
    out = counts.selectExpr("_rows", f"stack({len(cols)}, {stack_args}) AS (column_name, position, non_null)")
    types = {c: t for c, t in df.dtypes}
    type_map = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    return out.select(
        "column_name", F.col("position").cast("bigint").alias("position"),
        F.element_at(type_map, F.col("column_name")).alias("data_type"),
        F.col("non_null").cast("bigint").alias("non_null"), F.col("_rows").alias("rows"))


def id_lookup(df: DataFrame, ids: DataFrame, key: str = "post_id") -> DataFrame:
    """Rows whose ``key`` is in the first column of ``ids``: a left-semi join."""
    id_col = ids.columns[0]
    return df.join(ids.select(F.col(id_col).alias("_tf_id")), F.col(key) == F.col("_tf_id"), "left_semi")


def unlabelled(df: DataFrame, label: str = "recommend") -> DataFrame:
    """Rows without a label."""
    return df.where(F.col(label).isNull())


def table_sizes(spark: SparkSession, root: str, top: int | None = None) -> DataFrame:
    """Bytes per table below ``root`` (one table per file or directory).

    Reads file listings only (``binaryFile`` with the content column pruned),
    groups by table name and reports GB/MB by powers of 10 and a 1024-based
    human-readable size, largest first.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root) \
        .select("path", "length")
    rel = F.regexp_replace(F.col("path"), "^.*?" + _escape(root.rstrip("/")) + "/", "")
    table = F.regexp_replace(F.regexp_extract(rel, r"^([^/]+)", 1), r"\.parquet$", "")
    sizes = files.groupBy(table.alias("table_name")).agg(
        F.sum("length").alias("size_bytes"), F.count(F.lit(1)).alias("files"))
    sizes = sizes.select(
        "table_name", "size_bytes", "files",
        (F.col("size_bytes") / F.pow(F.lit(10.0), F.lit(9.0))).alias("size_gb"),
        (F.col("size_bytes") / F.pow(F.lit(10.0), F.lit(6.0))).alias("size_mb"),
        pretty_size(F.col("size_bytes")).alias("size_pretty"),
    )
    if top is not None:
        sizes = sizes.orderBy(F.col("size_bytes").desc(), "table_name").limit(top)
    return sizes


def pretty_size(b: F.Column) -> F.Column:
    """Human-readable size in bytes/kB/MB/GB/TB by powers of 1024 (rounded)."""
    def unit(p):
        return F.round(b / F.lit(float(1024 ** p))).cast("bigint").cast("string")
    return (F.when(b < 10 * 1024, F.concat(b.cast("string"), F.lit(" bytes")))
            .when(b < 10 * 1024 ** 2, F.concat(unit(1), F.lit(" kB")))
            .when(b < 10 * 1024 ** 3, F.concat(unit(2), F.lit(" MB")))
            .when(b < 10 * 1024 ** 4, F.concat(unit(3), F.lit(" GB")))
            .otherwise(F.concat(unit(4), F.lit(" TB"))))


def _escape(s: str) -> str:
    import re
    return re.escape(s)
