"""Scores kept increment by increment against the full run."""

import os
import random

from pyspark.sql import functions as F

from trustfeed.operators.running_maxima import RunningScores
from trustfeed.operators.scoring import author_maxima, with_post_score
from trustfeed.session import scratch_path

DDL = "post_id string, followship_rank bigint, age bigint, mirrors bigint, collects bigint, comments bigint"


def _rows(n, first=0):
    random.seed(first)
    number = lambda: random.choice([None, 0, random.randrange(50)])
    # a third of the posts has one author, some have none
    return [(f"p{first + i}", random.choice([1, None, random.randrange(2, 9)]), number(), number(), number(), number()) for i in range(n)]


def _bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path.removeprefix("file:")) for f in files)


def _rows_of(df):
    return {r["post_id"]: r.asDict() for r in df.collect()}


def test_increments_equal_the_full_run(spark):
    empty = spark.createDataFrame([], DDL)
    running = RunningScores(spark, scratch_path(spark, "running"), empty.schema, fanout=2, buckets=4)
    parts = [_rows(40), [], _rows(30, 100), _rows(20, 200)]
    for n, rows in enumerate(parts):
        running.add(n, spark.createDataFrame(rows, DDL))
        if n == 2:      # the same increment again, as after a crash
            running.add(n, spark.createDataFrame(rows, DDL))
    full = with_post_score(author_maxima(spark.createDataFrame([r for p in parts for r in p], DDL)))
    assert _rows_of(running.current()) == _rows_of(full)


def test_only_changed_authors_are_scored_again(spark):
    root = scratch_path(spark, "running")
    first = [(f"a{i}", i, 10, 10, 10, 10) for i in range(200)]
    running = RunningScores(spark, root, spark.createDataFrame([], DDL).schema, buckets=4)
    assert running.add(0, spark.createDataFrame(first, DDL)).count() == 200
    got = running.add(1, spark.createDataFrame([("b", 7, 1, 1, 1, 1), ("c", 8, 11, 1, 1, 1)], DDL))
    assert {r["post_id"] for r in got.collect()} == {"b", "c", "a8"}
    assert _bytes(f"{root}/scores/batch=1") < _bytes(f"{root}/scores/batch=0")
    # a post that comes again replaces its row
    running.add(2, spark.createDataFrame([("b", 7, 2, 20, 2, 2)], DDL))
    now = {r["post_id"]: r for r in running.current().collect()}
    assert len(now) == 202 and now["b"]["mirrors"] == 20 and now["a7"]["max_mirrors"] == 20 and now["a9"]["max_mirrors"] == 10
