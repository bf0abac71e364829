"""Every registered query against its DuckDB oracle on sf0.001 (the driver
runs the same comparison on sf0.01)."""

import pytest

import __spark_entry__ as entry
from trustfeed.plans.catalog import QUERIES as OWN
from conftest import SF_SMALL
from oracle_harness import compare

# The text operators' queries have their own tests.
QUERIES = {name: q for name, q in entry.queries().items() if name in OWN}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in OWN}

# No registered query may plan a cartesian/nested-loop join or evaluate
# Python row by row.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def assert_plan_clean(df):
    p = df._jdf.queryExecution().executedPlan().toString()
    assert not [m for m in FORBIDDEN if m in p], p


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck_small, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert_plan_clean(df)
    problems, _ = compare(df, duck_small, ORACLES[name])
    assert not problems, problems


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_query_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert_plan_clean(df)
    assert df.count() >= 0
    assert df.columns


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"post_id", "followship_rank", "post_score", "recommend"}


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
