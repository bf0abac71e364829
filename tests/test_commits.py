"""Commits to storage: crashes at every step, versions, manifests."""

import datetime as dt

import pytest

from trustfeed.operators import publish
from trustfeed.operators.publish import feed_versions, publish_feed, read_feed, version_path
from trustfeed.session import scratch_path
from trustfeed.sources import ledger

FEED = "strategy_name string, post_id string, v double"
POSTS = "post_id string, created_at timestamp"


class Lost(Exception):
    pass


def crash(*a, **k):
    raise Lost


def feed_rows(spark, table):
    return sorted((r["strategy_name"], r["post_id"], r["v"]) for r in read_feed(spark, table).collect())


# ------------------------------------------------------------------ A10
def test_readers_see_the_old_feed_until_the_commit(spark, monkeypatch):
    table = scratch_path(spark, "feed")
    old = spark.createDataFrame([("s", "old", 0.0)], FEED)
    new = spark.createDataFrame([("s", "new", 0.0), ("s", "newer", 1.0)], FEED)
    assert feed_rows(spark, table) == [] and publish_feed(old, table, "s") == 1
    with monkeypatch.context() as m:
        m.setattr(publish, "commit_version", crash)
        with pytest.raises(Lost):
            publish_feed(new, table, "s")
    # the new rows are written, and not to be seen
    assert spark.read.parquet(version_path(table, "s", 2)).count() == 2
    assert feed_rows(spark, table) == [("s", "old", 0.0)]
    with monkeypatch.context() as m:
        m.setattr(publish, "drop_path", crash)     # after the commit
        with pytest.raises(Lost):
            publish_feed(new.limit(1), table, "s", keep_seconds=0)
    assert len(feed_rows(spark, table)) == 1 and feed_rows(spark, table)[0][1] != "old"
    assert publish_feed(new, table, "s") == 3 and len(feed_rows(spark, table)) == 2


def test_a_resolved_version_stays_for_the_stated_time(spark):
    table = scratch_path(spark, "feed")
    start = dt.datetime(2024, 1, 1)
    for hours in range(4):
        publish_feed(spark.createDataFrame([("s", f"p{hours}", 0.0)], FEED), table, "s", start + dt.timedelta(hours=hours), 5400)
        if hours == 1:
            resolved = read_feed(spark, table)
    assert resolved.collect()[0]["post_id"] == "p1"      # replaced an hour ago
    publish_feed(spark.createDataFrame([("s", "p4", 0.0)], FEED), table, "s", start + dt.timedelta(hours=4), 5400)
    with pytest.raises(Exception):
        spark.read.parquet(version_path(table, "s", 1))
    assert [r["version"] for r in feed_versions(spark, table).orderBy("version").collect()] == [1, 2, 3, 4, 5]
    assert feed_rows(spark, table) == [("s", "p4", 0.0)]


# ------------------------------------------------------------------ A1-A4, A14
def source(spark, until):
    return spark.createDataFrame([(f"p{i}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i, microseconds=i)) for i in range(until)] +
                                 [("unknown", None)], POSTS)


@pytest.mark.parametrize("step", ["has_rows", "write_snapshot", "range_of", "append_record"])
@pytest.mark.parametrize("after_it", [False, True])
def test_a_crash_at_any_step_neither_repeats_nor_loses_rows(spark, monkeypatch, step, after_it):
    root, state = scratch_path(spark, "runs"), scratch_path(spark, "ledger")
    ledger.ingest_run(spark, source(spark, 10), root, state, 1, "created_at", "1970-01-01 00:00:00")
    own = getattr(ledger, step)

    def broken(*a, **k):
        if after_it:
            own(*a, **k)
        raise Lost
    with monkeypatch.context() as m:
        m.setattr(ledger, step, broken)
        with pytest.raises(Lost):
            ledger.ingest_run(spark, source(spark, 25), root, state, 2, "created_at")
    before = [r["post_id"] for r in ledger.read_runs(spark, root, state).collect()]
    assert len(before) == len(set(before)) == (25 if after_it and step == "append_record" else 10)
    # the source has grown; the next run has another id
    ledger.ingest_run(spark, source(spark, 40), root, state, 3, "created_at")
    assert ledger.ingest_run(spark, source(spark, 40), root, state, 4, "created_at") is None
    rows = ledger.read_runs(spark, root, state).collect()
    assert sorted(r["post_id"] for r in rows) == sorted(f"p{i}" for i in range(40))
    live = ledger.live_records(spark, state)
    assert all(a["high"] == b["after"] for a, b in zip(live, live[1:]))


def test_a_committed_run_is_left_as_it_is(spark):
    root, state = scratch_path(spark, "runs"), scratch_path(spark, "ledger")
    path = ledger.ingest_run(spark, source(spark, 5), root, state, 7, "created_at", "1970-01-01 00:00:00")
    assert ledger.ingest_run(spark, source(spark, 9), root, state, 7, "created_at") == path
    assert ledger.read_runs(spark, root, state).count() == 5
    assert ledger.ingest_run(spark, source(spark, 0), scratch_path(spark, "runs"), scratch_path(spark, "ledger"), 1, "created_at") is None


def test_a_read_opens_only_the_runs_it_needs(spark):
    """A thousand records; only the needed directories exist."""
    root, state = scratch_path(spark, "runs"), scratch_path(spark, "ledger")
    every = [(i, f"{root}/dtime={i}", 1, str(i - 1), str(i), str(i), i, i, []) for i in range(1, 1001)]
    spark.createDataFrame(every, ledger.RECORD).coalesce(1).write.parquet(state)
    for i in (500, 501, 999, 1000):
        spark.createDataFrame([(f"p{i}", i)], "post_id string, at bigint").write.parquet(f"{root}/dtime={i}")
    got = ledger.read_runs(spark, root, state, after_run=998)
    assert sorted((r["post_id"], r["dtime"]) for r in got.collect()) == [("p1000", 1000), ("p999", 999)]
    assert {f.rsplit("/", 2)[1] for f in got.inputFiles()} == {"dtime=999", "dtime=1000"}
    middle = ledger.read_runs(spark, root, state, low=499, high=501, dtype=int)
    assert sorted(r["at"] for r in middle.collect()) == [500, 501]
    none = ledger.read_runs(spark, root, state, after_run=1000, schema="post_id string, at bigint")
    assert none.collect() == [] and none.columns == ["post_id", "at", "dtime"]


def test_compacted_runs_hold_the_same_rows(spark, monkeypatch):
    root, state = scratch_path(spark, "runs"), scratch_path(spark, "ledger")
    for run, until in ((1, 3), (2, 5), (3, 60), (4, 62), (5, 65), (6, 70)):
        ledger.ingest_run(spark, source(spark, until), root, state, run, "created_at", "1970-01-01 00:00:00")
    want = sorted(tuple(r) for r in ledger.read_runs(spark, root, state).collect())
    with monkeypatch.context() as m:
        m.setattr(ledger, "append_record", crash)
        with pytest.raises(Lost):
            ledger.compact_runs(spark, root, state, 10, 20)
    assert sorted(tuple(r) for r in ledger.read_runs(spark, root, state).collect()) == want
    assert len(ledger.compact_runs(spark, root, state, 10, 20)) == 2
    assert [(r["first_run"], r["last_run"]) for r in ledger.live_records(spark, state)] == [(1, 2), (3, 3), (4, 6)]
    ledger.drop_replaced(spark, state)
    assert sorted(tuple(r) for r in ledger.read_runs(spark, root, state).collect()) == want
    assert {r["dtime"] for r in ledger.read_runs(spark, root, state, after_run=4).collect()} == {5, 6}
    # the cursor is still that of the newest run, and a later run goes on from there
    ledger.ingest_run(spark, source(spark, 71), root, state, 8, "created_at")
    assert ledger.read_runs(spark, root, state).count() == 71
    assert len(ledger.compact_runs(spark, root, state, 100, 1000)) == 1
    assert ledger.read_runs(spark, root, state).count() == 71 and len(ledger.live_records(spark, state)) == 1
