"""Physical-plan shape: the strategies the operators are written for."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from trustfeed.operators import sampling
from trustfeed.operators.dedupe import dedupe_by_key
from trustfeed.operators.global_rank import global_row_number
from trustfeed.operators.scoring import top_posts
from trustfeed.plans import chain
from trustfeed.session import scratch_path
from trustfeed.sources import increments
from trustfeed.sources.driver_tables import SourceTables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_global_rank_has_no_single_partition_window_over_rows(spark):
    df = spark.range(0, 1000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("v"))
    p = plan(global_row_number(df, [F.col("v").desc(), F.col("k")], "rank"))
    assert "row_number" not in p.lower()
    # the only window is the running sum over one row per partition
    assert p.count("Window ") <= 1


def test_capped_sample_uses_window_group_limit(spark):
    df = spark.range(0, 1000).select(F.col("id").cast("string").alias("post_id"),
                                     F.when(F.col("id") % 2 == 0, "1d").otherwise("1w").alias("b"))
    s = sampling.capped_sample(df, "b", {"1d": 10, "1w": 5})
    s.count()
    assert "WindowGroupLimit" in plan(s)


def test_top_posts_is_take_ordered(spark):
    scored = chain.scored_posts(SourceTables(spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan(top_posts(scored, 100, 10))


def test_increment_read_prunes_partitions(spark):
    root = scratch_path(spark, "prune")
    for run in (20230516000000, 20230517000000):
        increments.write_snapshot(spark.range(3), root, run)
    df = increments.read_increment(spark, root, 20230516000000)
    p = plan(df)
    assert "PartitionFilters: [isnotnull(dtime" in p and "> 20230516000000)]" in p
    assert df.count() == 3


def test_incremental_extract_pushes_filter_and_prunes_columns(spark):
    src = SourceTables(spark, SF_SMALL)
    df = increments.incremental_extract(src.profile_post(), "1996-06-30 00:00:00").select("post_id")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in p


def test_publication_stats_pre_aggregates_line_items(spark):
    p = plan(SourceTables(spark, SF_SMALL).publication_stats())
    assert "partial_sum" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string,l_linestatus:string>" in p


def test_dedupe_combines_before_shuffle(spark):
    df = spark.range(0, 100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    p = plan(dedupe_by_key(df, ["k"], ["v"]))
    assert "partial_min_by" in p


def test_hot_author_join_is_split_by_aqe(spark):
    """One author with a third of all posts: the maxima join back is a
    sort-merge join whose hot partition AQE splits (thresholds lowered so the
    small test data counts as skewed)."""
    from trustfeed.operators.scoring import author_maxima

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 30000
        df = spark.range(0, n).select(
            F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 997 + 2).cast("bigint")
            .alias("followship_rank"),
            (F.col("id") % 50).alias("age"), (F.col("id") % 7).alias("mirrors"),
            (F.col("id") % 5).alias("collects"), (F.col("id") % 3).alias("comments"))
        out = author_maxima(df)
        got = out.collect()                      # runs this Dataset's own (adaptive) plan
        assert len(got) == n
        assert {r["max_age"] for r in got if r["followship_rank"] == 1} == {49}
        final = out._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final
        joins = [line.strip() for line in final.splitlines() if "Join" in line]
        assert any("SortMergeJoin(skew=true)" in j for j in joins), joins
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)



def written_columns(spark, monkeypatch, run) -> list[set]:
    """The columns of every table that a query writes on its way."""
    import trustfeed.operators.features
    import trustfeed.operators.scoring
    import trustfeed.session as session
    real, seen = session.materialize, []

    def spy(df, name="stage"):
        seen.append(set(df.columns))
        return real(df, name)
    for module in (chain, trustfeed.operators.scoring, trustfeed.operators.features):
        monkeypatch.setattr(module, "materialize", spy)
    run()
    return seen


def test_stage_writes_hold_only_needed_columns(spark, monkeypatch):
    from trustfeed.plans.catalog import QUERIES
    score = {*chain.SCORE_INPUTS}
    for name in ("label_counts", "label_encoding"):
        for cols in written_columns(spark, monkeypatch, lambda n=name: QUERIES[n](spark, SF_SMALL)):
            assert len(cols) <= len(score), (name, cols)
    seen = written_columns(spark, monkeypatch, lambda: QUERIES["bucket_counts"](spark, SF_SMALL))
    assert all("language" not in cols and "followship_score" not in cols for cols in seen)


def test_rank_range_does_not_read_line_items(spark):
    from trustfeed.plans.catalog import QUERIES
    p = plan(QUERIES["rank_range"](spark, SF_SMALL))
    assert "l_orderkey" not in p and "lineitem" not in p


def test_deduplication_of_the_feed_is_narrow(spark):
    from trustfeed.operators.feed import current_eligible
    hist = chain.prediction_history(SourceTables(spark, SF_SMALL), chain.PREDICTION_COLUMNS)
    p = plan(current_eligible(hist))
    scans = [line for line in p.splitlines() if "ReadSchema" in line]
    assert scans and all("language" not in s.split("ReadSchema")[1] for s in scans), p
