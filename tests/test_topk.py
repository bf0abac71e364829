"""Top-k by a threshold against the plain order."""

import random

import pytest
from pyspark.sql import functions as F

from trustfeed.operators import topk


def _plain(rows, k):
    def order(r):
        none = r[1] is None or r[1] != r[1]
        return none, 0 if none else -r[1], r[0] is not None, r[0] or ""
    return [r[0] for r in sorted(rows, key=order)[:k]]


def _scores(kind, n):
    random.seed(n)
    return {
        "spread": lambda i: random.gauss(0, 1),
        "tied": lambda i: 1.0 if i % 3 else random.random(),
        "all equal": lambda i: 0.5,
        "steep": lambda i: 10.0 ** random.randrange(-300, 300),
        "nulls": lambda i: None if i % 10 else random.random(),
        "only nulls": lambda i: None,
        "nan": lambda i: random.choice([float("nan"), float("inf"), -0.0, 0.0, random.random()]),
    }[kind]


@pytest.mark.parametrize("kind", ["spread", "tied", "all equal", "steep", "nulls", "only nulls", "nan"])
def test_top_k_equals_the_plain_order(spark, kind):
    make = _scores(kind, 3000)
    rows = [(f"p{i:05d}", make(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id string, v double").coalesce(2)
    for k in (0, 350, 3000):
        assert [r["id"] for r in topk.top_k(df, "v", "id", k).collect()] == _plain(rows, k), (kind, k)


def test_empty_null_ids_and_other_numbers(spark):
    assert topk.top_k(spark.createDataFrame([], "id string, v double"), "v", "id", 3).collect() == []
    rows = [(None, 2)] * 2 + [(f"x{i}", i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "id string, v bigint")
    assert [r["id"] for r in topk.top_k(df, "v", "id", 5).collect()] == _plain(rows, 5)


@pytest.mark.parametrize("kind", ["spread", "tied"])
def test_rows_that_reach_the_last_sort_stay_near_k(spark, kind):
    """Whatever the number of map tasks: k rows of every task would be 64 * k."""
    make = _scores(kind, 20000)
    df = spark.createDataFrame([(f"p{i:05d}", make(i)) for i in range(20000)], "id string, v double").repartition(64)
    for k in (50,):
        assert k <= df.where(topk.top_k_filter(df, "v", "id", k)).count() <= topk.NEAR * k


def test_a_poor_sketch_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(topk, "ACCURACY", 20)
    df = spark.range(5000).select(F.col("id").cast("string").alias("id"), F.xxhash64("id").cast("double").alias("v"))
    rows = [(r["id"], r["v"]) for r in df.collect()]
    assert [r["id"] for r in topk.top_k(df.repartition(8), "v", "id", 20).collect()] == _plain(rows, 20)
