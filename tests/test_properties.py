"""Property tests on random inputs with hot values (few examples: each one runs Spark jobs)."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trustfeed.functions.columns import uniform_u32
from trustfeed.operators import sampling
from trustfeed.operators.dedupe import dedupe_by_key
from trustfeed.operators.global_rank import global_row_number

SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))

values = st.lists(st.one_of(st.just(0.5), st.floats(0, 1, allow_nan=False)), min_size=1, max_size=400)


@SETTINGS
@given(values, st.integers(1, 9))
def test_rank_is_a_permutation_in_key_order(spark, vals, parts):
    data = [(f"id{i:04d}", v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(data, "profile_id string, v double").repartition(parts)
    got = sorted((r["rank"], r["profile_id"]) for r in
                 global_row_number(df, [F.col("v").desc(), F.col("profile_id")], "rank").collect())
    expect = [d[0] for d in sorted(data, key=lambda r: (-r[1], r[0]))]
    assert [g[0] for g in got] == list(range(1, len(data) + 1))
    assert [g[1] for g in got] == expect


@SETTINGS
@given(st.lists(st.sampled_from(["a", "b", "c"]), min_size=1, max_size=600),
       st.dictionaries(st.sampled_from(["a", "b", "c"]), st.integers(1, 120), min_size=1))
def test_capped_sample_equals_brute_force(spark, buckets, caps):
    df = spark.createDataFrame([(f"p{i}", b) for i, b in enumerate(buckets)], "post_id string, b string")
    got = sorted(r[0] for r in sampling.capped_sample(df, "b", caps, seed="h").select("post_id").collect())
    keyed = df.withColumn("u", uniform_u32("post_id", "h")).toPandas()
    expect = []
    for b, g in keyed.groupby("b"):
        if b in caps:
            expect += list(g.sort_values(["u", "post_id"]).head(caps[b])["post_id"])
    assert got == sorted(expect)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["hot", "k1", "k2"]), st.integers(0, 5)), min_size=1, max_size=300))
def test_dedupe_survivor_is_first_in_order(spark, pairs):
    data = [(k, r, f"id{i:04d}") for i, (k, r) in enumerate(pairs)]
    df = spark.createDataFrame(data, "k string, rank int, id string")
    got = sorted(tuple(r) for r in dedupe_by_key(df, ["k"], ["rank", "id"]).collect())
    pdf = pd.DataFrame(data, columns=["k", "rank", "id"]).sort_values(["rank", "id"]).groupby("k").head(1)
    assert got == sorted((r.k, r.rank, r.id) for r in pdf.itertuples())
