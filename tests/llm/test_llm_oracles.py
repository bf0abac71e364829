"""The text operators' queries against their DuckDB oracles (whole tables of sf0.001)."""

import pytest

from conftest import SF_SMALL
from oracle_harness import compare
from trustfeed.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_llm_query_matches_oracle(spark, duck_small, name):
    problems, n = compare(QUERIES[name](spark, SF_SMALL), duck_small, ORACLES[name])
    assert not problems and n, problems


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


@pytest.mark.parametrize("name", ["op2_drop_recurring_lines", "op5_quality_rules"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop") if w in plan], plan
