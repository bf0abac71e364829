"""State of the keys that a stream has seen, kept in parts (L2).

A log-structured table: batch n writes the keys it has stored as segment n..n; when ``FANOUT`` segments of a size are there,
they are merged to one, so a key is rewritten once per power of ``FANOUT`` and not with every batch. Which segments hold the state
before batch n follows from n alone (the digits of n to the base ``FANOUT``), so there is nothing to commit beside them: a batch that
is replayed after a failure reads the same segments and writes the same ones over. Segments are divided into buckets by
key hash, and a batch reads only the buckets of its own keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustfeed.session import drop_path

FANOUT = 8
BUCKETS = 32


def segments_before(batch: int, fanout: int = FANOUT) -> list[tuple[int, int]]:
    """The segments (first, last batch) that hold the state before ``batch``, oldest first."""
    out, start, size = [], 0, 1
    while size * fanout <= batch:
        size *= fanout
    while size:
        while start + size <= batch:
            out.append((start, start + size - 1))
            start += size
        size //= fanout
    return out


def merges_after(batch: int, fanout: int = FANOUT) -> list[tuple[int, int]]:
    """The merged segments that end with ``batch``, smallest first."""
    out, size = [], fanout
    while size <= batch + 1 and (batch + 1) % size == 0:
        out.append((batch + 1 - size, batch))
        size *= fanout
    return out


class KeyState:
    """The newest time stored per key, as a table (key, time) in segments below ``root``."""

    def __init__(self, spark: SparkSession, root: str, key_type: str, time_type: str, fanout: int = FANOUT, buckets: int = BUCKETS):
        self.spark, self.root, self.fanout, self.buckets = spark, root.rstrip("/"), fanout, buckets
        self.schema = f"key {key_type}, time {time_type}, bucket int"

    def path(self, segment: tuple[int, int]) -> str:
        return f"{self.root}/segment={segment[0]}-{segment[1]}"

    def bucket(self, key):
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _read(self, segments: list[tuple[int, int]]) -> DataFrame:
        parts = [self.spark.read.schema(self.schema).parquet(self.path(s)) for s in segments]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def known(self, batch: int, keys: DataFrame, key_col: str) -> DataFrame | None:
        """(key, time) stored before ``batch`` in the buckets of ``keys``, a key once per segment that has it; None if nothing is."""
        segments = segments_before(batch, self.fanout)
        if not segments:
            return None
        own = [r["b"] for r in keys.select(self.bucket(key_col).alias("b")).distinct().collect()]     # BUCKETS at most
        return self._read(segments).where(F.col("bucket").isin(own)).select("key", "time")

    def _write(self, rows: DataFrame, segment: tuple[int, int]) -> None:
        rows.select("key", "time", self.bucket("key").alias("bucket")).repartition("bucket") \
            .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(self.path(segment))

    def store(self, batch: int, rows: DataFrame) -> None:
        """Segment ``batch``, from (key, time) rows, and the merges that it completes."""
        self._write(rows, (batch, batch))
        for first, last in merges_after(batch, self.fanout):
            size = (last - first + 1) // self.fanout
            parts = [(s, s + size - 1) for s in range(first, last + 1, size)]
            self._write(self._read(parts).groupBy("key").agg(F.max("time").alias("time")), (first, last))

    def forget(self, batch: int) -> None:
        """Delete what neither ``batch`` replayed nor the next one reads."""
        needed = {*segments_before(batch, self.fanout), *segments_before(batch + 1, self.fanout)}
        for segment in segments_before(batch - 1, self.fanout):
            if segment not in needed:
                drop_path(self.spark, self.path(segment))
        # the parts of a merge that was itself merged at once
        for first, last in merges_after(batch - 1, self.fanout):
            size = (last - first + 1) // self.fanout
            for s in range(first, last + 1, size):
                if (s, s + size - 1) not in needed:
                    drop_path(self.spark, self.path((s, s + size - 1)))
