"""Keyed state of streams: segments, replays, bytes written per batch."""

import os

import pytest
from pyspark.sql import functions as F

from trustfeed.session import scratch_path
from trustfeed.streaming.keyed_state import KeyState, merges_after, segments_before


@pytest.mark.parametrize("fanout", [2, 3, 8])
def test_segments_cover_every_batch_once(fanout):
    written = set()
    for batch in range(200):
        before = segments_before(batch, fanout)
        assert [b for first, last in before for b in range(first, last + 1)] == list(range(batch))
        assert set(before) <= written
        written.add((batch, batch))
        written |= set(merges_after(batch, fanout))
    assert len(segments_before(199, fanout)) <= (fanout - 1) * 8
    assert merges_after(-1, fanout) == [] and segments_before(0, fanout) == []


def size_of(path):
    path = path.removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_bytes_of_a_batch_do_not_grow_with_the_history(spark):
    """Each batch stores 40 new keys: its own segment stays as small as the first, and a key is rewritten once per merge level."""
    root = scratch_path(spark, "keys")
    state, sizes, merged = KeyState(spark, root, "string", "bigint", fanout=3, buckets=2), [], 0
    for batch in range(10):
        rows = spark.range(batch * 40, batch * 40 + 40).select(F.col("id").cast("string").alias("key"), F.lit(batch).cast("bigint").alias("time"))
        state.store(batch, rows)
        sizes.append(size_of(state.path((batch, batch))))
        merged += sum(size_of(state.path(m)) for m in merges_after(batch, 3))
        state.forget(batch)
    assert max(sizes) <= 1.5 * min(sizes) and merged <= 2 * sum(sizes)
    kept = {d for d in os.listdir(root.removeprefix("file:")) if d.startswith("segment")}
    assert kept == {f"segment={a}-{b}" for a, b in {*segments_before(9, 3), *segments_before(10, 3)}}
    asked = spark.createDataFrame([("7",), ("395",), ("400",)], "post_id string")
    known = state.known(10, asked, "post_id").join(asked.withColumnRenamed("post_id", "key"), "key").collect()
    assert sorted((r["key"], r["time"]) for r in known) == [("395", 9), ("7", 0)]


def test_a_replayed_batch_starts_from_the_same_state(spark):
    root = scratch_path(spark, "keys")
    state = KeyState(spark, root, "string", "bigint", fanout=2, buckets=2)

    def rows(batch):
        return spark.createDataFrame([(f"k{batch}", batch), ("every", batch)], "key string, time bigint")
    seen = []
    for batch in (0, 1, 2, 3, 3, 4, 4, 5):          # 3 and 4 are replayed after their merges and deletions
        known = state.known(batch, rows(batch), "key")
        seen.append((batch, sorted({(r["key"], r["time"]) for r in known.collect()}) if known is not None else []))
        state.store(batch, rows(batch))
        state.forget(batch)
    assert seen[3] == seen[4] and seen[5] == seen[6]
    assert max(t for k, t in seen[-1][1] if k == "every") == 4 and state.known(6, rows(6), "key").where("key = 'every'").count() >= 1
