"""Incremental ingestion by cursor, run snapshots, prediction sink.

A cursor (watermark) is one scalar per table and stage, kept in a small
Parquet state table next to the data, one row per run; it is computed from the
data that was actually written, never from a second scan of the source.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustfeed.params import DEFAULT_EXTRACT_WATERMARK, DEFAULT_PARTITION_WATERMARK


def incremental_extract(df: DataFrame, watermark=DEFAULT_EXTRACT_WATERMARK,
                        col: str = "block_timestamp") -> DataFrame:
    """A1: rows strictly newer than the cursor (pushed down to the scan)."""
    return df.where(F.col(col) > F.lit(watermark).cast("timestamp"))


def next_watermark(df: DataFrame, col: str = "block_timestamp", name: str = "watermark") -> DataFrame:
    """The new cursor = max of the cursor column (one row)."""
    return df.agg(F.max(col).alias(name))


def has_rows(df: DataFrame) -> bool:
    """Stop at the first row instead of counting the increment."""
    return not df.isEmpty()


def snapshot_path(root: str, run_dtime: int) -> str:
    return f"{root.rstrip('/')}/dtime={int(run_dtime)}"


def write_snapshot(df: DataFrame, root: str, run_dtime: int) -> str:
    """A2: write one run's rows to its own ``dtime=`` directory (overwrite only it)."""
    path = snapshot_path(root, run_dtime)
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return path


def read_if_written(spark: SparkSession, path: str):
    """The Parquet table at ``path``, or None if nothing was ever committed there. Other errors are raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_increment(spark: SparkSession, root: str, watermark: int = DEFAULT_PARTITION_WATERMARK,
                   schema=None) -> DataFrame:
    """A4: runs with ``dtime > watermark``; pruned on the directory listing."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(root).where(F.col("dtime") > F.lit(int(watermark)))


def load_cursor(spark: SparkSession, state_path: str, default):
    """The newest stored cursor, or ``default`` on the first run (no state table)."""
    state = read_if_written(spark, state_path)
    row = None if state is None else state.agg(F.max("watermark").alias("w")).first()
    return default if row is None or row["w"] is None else row["w"]


def save_cursor(cursor_df: DataFrame, state_path: str) -> None:
    """Add the new cursor beside the old ones; the newest counts, so a crash here leaves the old one valid."""
    cursor_df.coalesce(1).write.mode("append").parquet(state_path)


def save_predictions(preds: DataFrame, root: str, run_dtime: int) -> str:
    """``root/dtime=<run>/recommend=<label>/``; the whole run directory is replaced, whatever labels it held."""
    path = snapshot_path(root, run_dtime)
    preds.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("recommend").parquet(path)
    return path


# NULL marker of our own CSV exports; with the reader default (empty field ->
# NULL) an empty string could not be told apart from NULL.
CSV_NULL = "\\N"


def read_csv_export(spark: SparkSession, path: str, schema, null_value: str | None = None) -> DataFrame:
    """CSV with header, '"'-escaped quotes and fields spanning lines.

    An explicit schema avoids the extra inference pass over the data.
    ``null_value``: the NULL marker (default: empty field is NULL).
    """
    reader = spark.read.schema(schema).option("header", True).option("escape", '"') \
        .option("multiLine", True)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return reader.csv(path)


def write_csv_export(df: DataFrame, path: str, null_value: str = CSV_NULL) -> None:
    """CSV writer matching ``read_csv_export`` (quotes doubled, whitespace kept)."""
    df.write.mode("overwrite").option("header", True).option("escape", '"') \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False) \
        .option("nullValue", null_value).csv(path)
