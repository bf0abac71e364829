"""A10: publish a feed without a moment in which readers see none.

Every publication of a strategy is a directory of its own, ``versions/strategy_name=<s>/version=<n>``; a small pointer table beside
them says which versions are complete. The append of the pointer's row (one file, so one rename) is the commit: until
then readers resolve the version before, and a publication that crashed is written over by the next one. Versions that
were replaced more than ``keep_seconds`` ago are deleted, so a reader that has resolved a version may go on with it for that time.
One writer per strategy at a time.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustfeed.session import drop_path
from trustfeed.sources.increments import read_if_written

FEED = "post_id string, v double"
POINTER = "strategy_name string, version bigint, rows bigint, published_at timestamp"
KEEP_SECONDS = 24 * 3600


def feed_versions(spark: SparkSession, path: str) -> DataFrame:
    """The pointer table: (strategy_name, version, rows, published_at) of every complete publication."""
    pointer = f"{path.rstrip('/')}/pointer"
    if read_if_written(spark, pointer) is None:
        return spark.createDataFrame([], POINTER)
    return spark.read.schema(POINTER).parquet(pointer)


def version_path(path: str, strategy_name: str, version: int) -> str:
    return f"{path.rstrip('/')}/versions/strategy_name={quote(strategy_name, safe=' -_.')}/version={version}"


def commit_version(spark: SparkSession, path: str, strategy_name: str, version: int, rows: int, published_at: datetime) -> None:
    row = [(strategy_name, version, rows, published_at)]
    spark.createDataFrame(row, POINTER).coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/pointer")


def publish_feed(feed: DataFrame, path: str, strategy_name: str, published_at: datetime | None = None,
                 keep_seconds: int = KEEP_SECONDS) -> int:
    """Replace the rows of ``strategy_name``, also by none, and leave other strategies; returns the new version."""
    spark = feed.sparkSession
    published_at = published_at or datetime.now(timezone.utc).replace(tzinfo=None)
    known = feed_versions(spark, path).where(F.col("strategy_name") == strategy_name).orderBy("version").collect()
    version = known[-1]["version"] + 1 if known else 1
    target = version_path(path, strategy_name, version)
    own = feed.where(F.col("strategy_name") == strategy_name).select("post_id", F.col("v").cast("double").alias("v"))
    own.write.mode("overwrite").parquet(target)
    rows = spark.read.schema(FEED).parquet(target).count()
    commit_version(spark, path, strategy_name, version, rows, published_at)
    # newest first: a version goes with the time at which its successor came; what lies before a missing one is gone already
    replaced_at = published_at
    for old in reversed(known):
        if published_at - replaced_at >= timedelta(seconds=keep_seconds) and \
                not drop_path(spark, version_path(path, strategy_name, old["version"])):
            break
        replaced_at = old["published_at"]
    return version


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """(strategy_name, post_id, v) of the newest complete version of every strategy."""
    newest = feed_versions(spark, path).groupBy("strategy_name").agg(F.max("version").alias("version")).collect()
    if not newest:
        return spark.createDataFrame([], f"strategy_name string, {FEED}")
    parts = [spark.read.schema(FEED).parquet(version_path(path, r["strategy_name"], r["version"])).select(
        F.lit(r["strategy_name"]).alias("strategy_name"), "post_id", "v") for r in newest]
    return reduce(DataFrame.unionByName, parts)
