"""Increment ingestion with a managed cursor (L1) and cross-increment
de-duplication (L2) on Structured Streaming.

The file source over the ``dtime=`` tree remembers which files it has seen
in the checkpoint, which replaces the hand-kept cursor files: a run with
``availableNow`` processes everything new, in one or more micro-batches, and
stops. Each micro-batch runs the ordinary batch operators through
``foreachBatch`` and writes to its own ``batch=<id>`` directory with
overwrite, so a replayed batch (at-least-once delivery after a failure)
replaces its earlier output instead of duplicating it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trustfeed.operators.dedupe import latest_per_post
from trustfeed.session import materialize
from trustfeed.streaming.keyed_state import KeyState


def run_increment(spark: SparkSession, source_root: str, schema: StructType, checkpoint: str,
                  out_root: str, transform: Callable[[DataFrame], DataFrame],
                  max_files_per_trigger: int | None = None, dedupe_key: str | None = None,
                  time_col: str = "dtime") -> None:
    """Process all not-yet-seen files below ``source_root`` and stop.

    ``schema`` must include the partition column (``dtime``). With
    ``dedupe_key`` (L2) a batch keeps the newest row per key and drops keys
    already stored with an equal or newer ``time_col``. What is stored is known
    from a key table in parts beside the output (``keyed_state``): a batch reads
    the buckets of its own keys and writes its own keys, before its output, so
    a batch replayed after a failure starts from the same state again.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_root)

    def handle(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch)
        target = f"{out_root.rstrip('/')}/batch={batch_id}"
        if dedupe_key is None:
            out.write.mode("overwrite").parquet(target)
            return
        # read for its buckets, its keys and its rows
        out = materialize(latest_per_post(out, dedupe_key, time_col), "stream-newest")
        state = KeyState(spark, f"{out_root.rstrip('/')}-keys", *(out.schema[c].dataType.simpleString() for c in (dedupe_key, time_col)))
        known = state.known(batch_id, out, dedupe_key)
        if known is not None:
            out = out.join(known, (out[dedupe_key] == known["key"]) & (known["time"] >= out[time_col]), "left_anti")
        out = materialize(out, "stream-batch")
        state.store(batch_id, out.select(F.col(dedupe_key).alias("key"), F.col(time_col).alias("time")))
        out.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(target)
        state.forget(batch_id)

    query = stream.writeStream.foreachBatch(handle) \
        .option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
    query.awaitTermination()


def read_output(spark: SparkSession, out_root: str) -> DataFrame:
    """All written batches (the ``batch`` directory column dropped)."""
    return spark.read.parquet(out_root).drop("batch")


def run_watermarked(spark: SparkSession, source_root: str, schema: StructType, checkpoint: str, out_root: str, key: str,
                    event_time: str, delay: str) -> None:
    """L2 with bounded state: the first row of a key stays, others of it within ``delay`` go; process what is new and stop.

    Spark's own state store holds a key until the watermark (the newest ``event_time`` less ``delay``) has passed its time
    by ``delay``; rows older than the watermark are late and dropped. A key that comes again after that is new.
    """
    rows = spark.readStream.schema(schema).parquet(source_root).withWatermark(event_time, delay)
    query = rows.dropDuplicatesWithinWatermark([key]).writeStream.format("parquet").option("path", out_root) \
        .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
