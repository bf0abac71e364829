"""Near duplicates: which shingle sets are moved."""

import re

import pytest

from trustfeed.llm import near_dedup

IDS = "node bigint, ids array<bigint>"


@pytest.fixture
def shuffled(spark):
    """Rows with shingle sets that the exchanges of a query write, with all joins by shuffle unless asked otherwise."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def blocks(df):
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        return [x for x in re.split(r"\n\(\d+\) ", text) if x.startswith("Exchange") and "ids" in x.split("Arguments")[0]], text

    yield blocks
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _sets(spark, n=40):
    return spark.createDataFrame([(i, [(i + k) << 32 for k in range(5)]) for i in range(n)], IDS)


def test_shared_shingles_leave_the_sets_where_they_are(spark, shuffled):
    wanted = spark.createDataFrame([(0, 5), (1, 5), (20, 5)], "node bigint, n int")
    got = near_dedup._shared_shingles(_sets(spark), wanted)
    assert {r["node"]: r["common"] for r in got.collect()} == {0: 4, 1: 4, 20: 0}
    assert shuffled(got)[0] == []


def test_only_named_sets_are_moved(spark, shuffled):
    sets = _sets(spark)
    pairs = spark.createDataFrame([(0, 1), (0, 30)], "a bigint, b bigint")
    got = near_dedup._verified(pairs, sets, 0.6)
    assert [(r["a"], r["b"]) for r in got.collect()] == [(0, 1)]
    moved, text = shuffled(got)
    assert moved and text.count("bitmap_construct_agg") >= 2
    named = spark.createDataFrame([(0, 1), (0, 30)], "centre bigint, node bigint")
    got = near_dedup._beside_centres(named, sets)
    assert {r["node"]: (r["both"], len(r["rest"])) for r in got.collect()} == {1: (4, 1), 30: (0, 5)}
    assert shuffled(got)[1].count("bitmap_construct_agg") >= 2
