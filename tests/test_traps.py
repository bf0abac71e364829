"""Hand-made frames for the semantic traps and null paths."""

import datetime as dt
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from trustfeed.functions.columns import id_head, id_tail, pg_concat, uniform_u32
from trustfeed import schemas
from trustfeed.operators import feed, features, model, quality, sampling, views
from trustfeed.operators.publish import publish_feed, read_feed
from trustfeed.operators.dedupe import dedupe_by_key, latest_per_post
from trustfeed.operators.global_rank import global_row_number
from trustfeed.operators.posts import post_flags
from trustfeed.operators.scoring import author_maxima, heuristic_labels, with_post_score
from trustfeed.params import FeedParams, LabelParams
from trustfeed.session import scratch_path
from trustfeed.sources import increments


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()] if cols else [tuple(r) for r in df.collect()]


# ---------------------------------------------------------------- T1 recency
def test_recency_elapsed_and_packed(spark):
    df = spark.createDataFrame([(20230531235959,), (20230531000000,), (20230525000000,), (20230401000000,)],
                               "dtime bigint")
    now = "2023-06-01 00:00:00"
    b = FeedParams().buckets
    elapsed = dict(rows(feed.recency_bucket(df, now, b), "dtime", "time_ago"))
    packed = dict(rows(feed.recency_bucket(df, now, b, mode="packed"), "dtime", "time_ago"))
    # one second before midnight is 1 day old in real time, but 69,764,041 apart packed
    assert elapsed[20230531235959] == "1d" and packed[20230531235959] == "99w"
    # exactly one day across a month end: not < 86400 -> 1w; packed 70,000,000 -> 99w
    assert elapsed[20230531000000] == "1w" and packed[20230531000000] == "99w"
    mid = spark.createDataFrame([(20230514000000,)], "dtime bigint")
    # one day inside a month: packed difference 1,000,000 falls in 4w
    assert rows(feed.recency_bucket(mid, "2023-05-15 00:00:00", b, mode="packed"), "time_ago") == [("4w",)]
    assert rows(feed.recency_bucket(mid, "2023-05-15 00:00:00", b), "time_ago") == [("1w",)]
    assert elapsed[20230525000000] == "4w"
    assert elapsed[20230401000000] == "99w"


# ---------------------------------------------------------------- B2 flags, text booleans
def test_post_flags_bad_boolean_text_is_null(spark):
    schema = ("post_id string, profile_id string, is_related_to_post string, is_related_to_comment string, "
              "is_hidden string, is_gated string, block_timestamp timestamp, language string, region string, "
              "content_warning string, main_content_focus string, tags_vector string, "
              "custom_filters_gardener_flagged string")
    ts = dt.datetime(2001, 12, 31, 23, 59)
    df = spark.createDataFrame([
        ("p1", "a", None, None, "true", "maybe", ts, "en", None, None, "TEXT_ONLY", None, None),
        ("p2", "a", "x-1", None, "false", "false", ts, "en", "US", "NSFW", "IMAGE", None, "true"),
    ], schema)
    out = {r["post_id"]: r for r in post_flags(df, "2002-01-01 00:00:00").collect()}
    assert out["p1"]["is_hidden"] is True and out["p1"]["is_gated"] is None
    assert out["p1"]["is_original"] is True and out["p1"]["is_content_warning"] is False
    assert out["p1"]["custom_filters_gardener_flagged"] is None
    assert out["p2"]["is_original"] is False and out["p2"]["is_content_warning"] is True
    # one minute before midnight is one calendar day old
    assert out["p1"]["age"] == 1


# ---------------------------------------------------------------- string functions
def test_compound_id_parsing_and_pg_concat(spark):
    df = spark.createDataFrame([("0x1-0x2",), ("nodash",), ("a-b-c",), (None,)], "x string")
    got = rows(df.select(id_head("x"), id_tail("x"), pg_concat("x", F.lit("-"), F.lit(None).cast("string"))))
    assert got == [("0x1", "0x2", "0x1-0x2-"), ("", "nodash", "nodash-"), ("a", "b-c", "a-b-c-"),
                   (None, None, "-")]


# ---------------------------------------------------------------- H1 score null paths
def test_post_score_null_and_zero_maxima(spark):
    df = spark.createDataFrame([
        ("p1", 1, 10, 2, 0, 4),      # author 1: max collects 0 -> divisor 1e10
        ("p2", 1, 20, 4, 0, None),   # NULL counter -> NULL score
        ("p3", None, 5, 1, 1, 1),    # unranked: NULL maxima -> all divisors 1e10
    ], "post_id string, followship_rank bigint, age bigint, mirrors bigint, collects bigint, comments bigint")
    scored = {r["post_id"]: r for r in with_post_score(author_maxima(df)).collect()}
    p1 = scored["p1"]
    assert p1["max_collects"] is None  # zero maximum becomes NULL
    assert p1["post_score"] == pytest.approx(2 / 4 + 0 / 1e10 + 3 * 4 / 4 - 5 * 10 / 20)
    assert scored["p2"]["post_score"] is None
    assert scored["p3"]["post_score"] == pytest.approx((1 + 1 + 3 - 25) / 1e10)


# ---------------------------------------------------------------- H2 label precedence
def test_label_precedence(spark):
    df = spark.createDataFrame([
        ("a", 1, 0.9), ("b", 2, 0.1), ("c", 5, 0.5), ("d", 50, 0.99), ("e", None, 0.7), ("f", 1, None),
    ], "post_id string, followship_rank bigint, post_score double")
    lab = dict(rows(heuristic_labels(df, LabelParams(yes_rank=5, no_rank=50, top_k=2)), "post_id", "recommend"))
    assert lab == {"a": "YES", "c": "YES", "b": "MAYBE", "f": "MAYBE", "d": "NO", "e": None}


# ---------------------------------------------------------------- E1 rank with heavy ties
def test_global_row_number_is_exact_permutation_with_hot_value(spark):
    random.seed(3)
    data = [(f"id{i:05d}", 0.5 if i % 3 == 0 else round(random.random(), 3)) for i in range(6000)]
    df = spark.createDataFrame(data, "profile_id string, v double").repartition(7)
    ranked = global_row_number(df, [F.col("v").desc(), F.col("profile_id").asc()], "rank")
    got = sorted(rows(ranked, "rank", "profile_id"))
    expect = sorted(data, key=lambda r: (-r[1], r[0]))
    assert [r[0] for r in got] == list(range(1, len(data) + 1))
    assert [r[1] for r in got] == [e[0] for e in expect]


# ---------------------------------------------------------------- D7 terciles
def test_popularity_bins_match_pandas_qcut(spark):
    random.seed(5)
    vals = [random.randint(1, 60) for _ in range(1000)]
    df = spark.createDataFrame([(f"p{i}", v) for i, v in enumerate(vals)], "post_id string, engagement_score int")
    got = dict(rows(feed.popularity_bins(df), "post_id", "popularity"))
    cut = pd.qcut(pd.Series(vals), q=3, labels=["C", "B", "A"])
    assert all(got[f"p{i}"] == cut[i] for i in range(len(vals)))


def test_popularity_bins_equal_cut_points_do_not_fail(spark):
    df = spark.createDataFrame([(f"p{i}", 5) for i in range(30)], "post_id string, engagement_score int")
    assert set(r[0] for r in rows(feed.popularity_bins(df), "popularity")) == {"C"}


# ---------------------------------------------------------------- I1 / I2 sampling
def test_capped_sample_exact_bounded_repeatable(spark):
    data = [(f"p{i}", ["1d", "1w", "4w", "99w"][i % 7 % 4]) for i in range(20000)]
    df = spark.createDataFrame(data, "post_id string, time_ago string").repartition(5)
    caps = {"1d": 500, "1w": 100, "4w": 100, "99w": 10000}
    s1 = sampling.capped_sample(df, "time_ago", caps, seed="s")
    got = rows(s1, "post_id", "time_ago")
    # brute force: the cap smallest hash keys per bucket
    keyed = df.withColumn("u", uniform_u32("post_id", "s")).toPandas()
    expect = set()
    for b, g in keyed.groupby("time_ago"):
        expect |= set(g.sort_values(["u", "post_id"]).head(caps[b])["post_id"])
    assert set(r[0] for r in got) == expect
    counts = pd.Series([r[1] for r in got]).value_counts().to_dict()
    assert all(counts[b] <= caps[b] for b in counts)
    assert sorted(got) == sorted(rows(sampling.capped_sample(df, "time_ago", caps, seed="s"),
                                      "post_id", "time_ago"))
    assert set(r[0] for r in rows(sampling.capped_sample(df, "time_ago", caps, seed="t"), "post_id")) != expect


def test_weighted_sample_size_and_zero_weight(spark):
    df = spark.createDataFrame([(f"p{i}", 0.0 if i < 10 else 0.1 + (i % 3) / 3) for i in range(300)],
                               "post_id string, weights double")
    s = sampling.weighted_sample(df, "weights", 100)
    ids = set(r[0] for r in rows(s, "post_id"))
    assert len(ids) == 100 and not any(f"p{i}" in ids for i in range(10))
    assert sampling.weighted_sample(df, "weights", 1000).count() == 290


# ---------------------------------------------------------------- G2 / G3 de-dup
def test_dedupe_hot_key_matches_brute_force(spark):
    random.seed(7)
    data = [("hot" if i % 3 == 0 else f"k{i % 50}", random.randint(0, 100), f"id{i}") for i in range(3000)]
    df = spark.createDataFrame(data, "k string, rank int, id string")
    got = dict((r[0], (r[1], r[2])) for r in rows(dedupe_by_key(df, ["k"], ["rank", "id"])))
    pdf = pd.DataFrame(data, columns=["k", "rank", "id"]).sort_values(["rank", "id"]).groupby("k").head(1)
    assert got == {r.k: (r.rank, r.id) for r in pdf.itertuples()}


def test_latest_per_post_same_post_two_runs(spark):
    df = spark.createDataFrame([("p1", 20230601000000, "NO"), ("p1", 20230602000000, "YES"),
                                ("p2", 20230601000000, "MAYBE")], "post_id string, dtime bigint, recommend string")
    assert sorted(rows(latest_per_post(df))) == [("p1", 20230602000000, "YES"), ("p2", 20230601000000, "MAYBE")]


# ---------------------------------------------------------------- B10 fill
def test_fill_nulls_by_type(spark):
    df = spark.createDataFrame([("p", None, None, None, None)],
                               "post_id string, followship_rank bigint, mirrors bigint, region string, flag boolean")
    r = feed.fill_nulls(df).collect()[0]
    assert (r["followship_rank"], r["mirrors"], r["region"], r["flag"]) == (10 ** 10, 0, "", None)


# ---------------------------------------------------------------- C12 point in time
def test_point_in_time_rowwise_and_per_feature(spark):
    hist = spark.createDataFrame([
        ("a", dt.datetime(2023, 1, 1), 1, "x"),
        ("a", dt.datetime(2023, 2, 1), 2, None),   # newest row has a NULL feature
        ("a", dt.datetime(2023, 9, 1), 3, "z"),    # after the instance time
        ("b", dt.datetime(2020, 1, 1), 9, "old"),  # before start_time
    ], "entity_id string, feature_time timestamp, n int, s string")
    inst = spark.createDataFrame([("a",), ("b",), ("c",)], "e string")
    look = [("e", hist, "x")]
    row = {r["e"]: (r["n"], r["s"]) for r in
           features.point_in_time(inst, look, "2023-06-01 00:00:00", "2022-01-01 00:00:00").collect()}
    assert row == {"a": (2, None), "b": (None, None), "c": (None, None)}
    per = {r["e"]: (r["n"], r["s"]) for r in
           features.point_in_time(inst, look, "2023-06-01 00:00:00", "2022-01-01 00:00:00",
                                  per_feature=True).collect()}
    assert per["a"] == (2, "x")


def test_point_in_time_asof_per_row(spark):
    hist = spark.createDataFrame([
        ("a", dt.datetime(2023, 1, 1), 1), ("a", dt.datetime(2023, 3, 1), 2),
    ], "entity_id string, feature_time timestamp, n int")
    inst = spark.createDataFrame([("a", dt.datetime(2023, 2, 1)), ("a", dt.datetime(2023, 4, 1)),
                                  ("a", dt.datetime(2022, 4, 1))], "e string, timestamp timestamp")
    got = sorted((r["timestamp"].month, r["timestamp"].year, r["n"])
                 for r in features.point_in_time_asof(inst, [("e", hist, "x")]).collect())
    assert got == [(2, 2023, 1), (4, 2022, None), (4, 2023, 2)]


# ---------------------------------------------------------------- A1-A4, A14 increments
def test_increments_equal_full_run_and_empty_guard(spark):
    root = scratch_path(spark, "inc")
    df = spark.range(0, 30).select(F.col("id").cast("string").alias("post_id"),
                                   (F.lit(20230516000000) + (F.col("id") % 3) * 1000000).alias("dtime"))
    for run in (20230516000000, 20230517000000, 20230518000000):
        increments.write_snapshot(df.where(F.col("dtime") == run).drop("dtime"), root, run)
    first = increments.read_increment(spark, root)                # all runs past the default cursor
    cursor = increments.next_watermark(first, "dtime").first()[0]
    assert cursor == 20230518000000 and first.count() == 30
    again = increments.read_increment(spark, root, cursor)
    assert not increments.has_rows(again)
    increments.write_snapshot(df.where(F.col("dtime") == 20230516000000).drop("dtime"), root, 20230519000000)
    assert increments.read_increment(spark, root, cursor).count() == 10


def test_cursor_state_roundtrip(spark):
    state = scratch_path(spark, "cursor")
    assert increments.load_cursor(spark, state, 7) == 7
    increments.save_cursor(spark.createDataFrame([(42,)], "watermark bigint"), state)
    assert increments.load_cursor(spark, state, 7) == 42


# ---------------------------------------------------------------- A6 CSV
def test_csv_quotes_line_breaks_whitespace(spark):
    data = [(1, 'say "hi"', "a"), (2, "line1\nline2\r\nline3", "b"), (3, "  padded, with comma  ", "c"),
            (4, "", "d"), (5, None, "e")]
    df = spark.createDataFrame(data, "id int, text string, tag string")
    path = scratch_path(spark, "csv")
    increments.write_csv_export(df, path)
    back = sorted(rows(increments.read_csv_export(spark, path, df.schema, increments.CSV_NULL)))
    assert back == sorted(data)


# ---------------------------------------------------------------- A10 publish
def test_publish_leaves_other_strategies(spark):
    table = scratch_path(spark, "feedtab")
    a = spark.createDataFrame([("s1", "p1", 0.0), ("s1", "p2", 1.0)], "strategy_name string, post_id string, v double")
    b = spark.createDataFrame([("s2", "q1", 0.0)], "strategy_name string, post_id string, v double")
    publish_feed(a, table, "s1")
    publish_feed(b, table, "s2")
    publish_feed(spark.createDataFrame([("s1", "p9", 0.0)], a.schema), table, "s1")
    got = sorted(rows(read_feed(spark, table), "strategy_name", "post_id"))
    assert got == [("s1", "p9"), ("s2", "q1")]


# ---------------------------------------------------------------- K views null paths
def test_wallet_left_join_fans_out_and_keeps_unmatched(spark):
    prof = spark.createDataFrame([("0x1", "w1"), ("0x2", "w1")], "profile_id string, owned_by string")
    fol = spark.createDataFrame([("w1", "0x9", dt.datetime(2024, 1, 1)), ("w7", "0x9", dt.datetime(2024, 1, 1))],
                                "address string, follow_profile_id string, block_timestamp timestamp")
    follows = views.view_follows(fol, prof)
    assert sorted(rows(follows, "profile_id"), key=str) == [("0x1",), ("0x2",), (None,)]
    counts = dict(rows(views.view_follow_counts(fol, prof)))
    assert counts == {"0x1": 1, "0x2": 1, None: 1}


def test_collect_currency_scales_amount(spark):
    det = spark.createDataFrame([("0x1-0x1", 2 * 10 ** 18, "0x0d500B1d8E8eF31E21C99d1Db9A6444d3ADf1270"),
                                 ("0x1-0x1", None, "0xother")], "publication_id string, amount bigint, currency string")
    posts = spark.createDataFrame([("0x1-0x1",)], "post_id string")
    got = rows(views.collect_currency(det, posts), "amt", "currency_symbol")
    assert got == [(2.0, "MATIC")]


# ---------------------------------------------------------------- D10 profile
def test_column_profile_counts(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, "y")], "a int, b string")
    got = sorted(rows(quality.column_profile(df), "column_name", "data_type", "non_null", "rows"))
    assert got == [("a", "int", 2, 3), ("b", "string", 2, 3)]


# ---------------------------------------------------------------- A13 model roundtrip
def test_model_save_load_same_predictions(spark):
    from trustfeed.operators import model

    random.seed(11)
    data = []
    for i in range(400):
        rank = random.randint(1, 3000)
        lab = "MAYBE" if rank <= 100 else ("NO" if rank >= 1000 else None)
        data.append((f"p{i}", rank, random.randint(0, 9), random.choice(["en", "de", None]), lab))
    df = spark.createDataFrame(data, "post_id string, followship_rank bigint, mirrors bigint, language string, "
                                     "recommend string")
    for c in ["age", "collects", "comments", "upvotes", "downvotes", "max_age", "max_mirrors", "max_collects",
              "max_comments"]:
        df = df.withColumn(c, F.lit(1).cast("bigint"))
    df = df.withColumn("followship_score", F.lit(0.5)).withColumn("post_score", F.lit(0.1)) \
        .withColumn("is_original", F.lit(True)).withColumn("is_content_warning", F.lit(False)) \
        .withColumn("custom_filters_gardener_flagged", F.lit(None).cast("boolean")) \
        .withColumn("region", F.lit("US")).withColumn("content_warning", F.lit(None).cast("string")) \
        .withColumn("main_content_focus", F.lit("IMAGE"))
    m = model.train(df, "rf", num_trees=5, max_depth=3)
    path = model.save_model(m, scratch_path(spark, "models"), "v1")
    loaded = model.load_model(os.path.dirname(path), "v1")
    p1 = sorted(rows(model.predict(m, df.drop("recommend")), "post_id", "recommend"))
    p2 = sorted(rows(model.predict(loaded, df.drop("recommend")), "post_id", "recommend"))
    assert p1 == p2
    assert {r[1] for r in p1} <= {"MAYBE", "NO"}
    assert dict(model.feature_importance(m))


# ---------------------------------------------------------------- B9 typing, A5/A7 readers, A11 table
def test_enforce_schema_try_cast_and_missing(spark):
    from trustfeed import schemas
    df = spark.createDataFrame([("p", "12", "notanumber")], "post_id string, age string, mirrors string")
    out = schemas.enforce(df, schemas.POST_FEATURES).collect()[0]
    assert out["age"] == 12 and out["mirrors"] is None and out["recommend"] is None and out["post_id"] == "p"


def test_read_source_parquet_and_feature_table_roundtrip(spark):
    from trustfeed.sources.readers import read_parquet, read_source
    path = scratch_path(spark, "features")
    a = features.ingest_features(spark.createDataFrame([("x", 1)], "id string, n bigint"), "id",
                                 "2023-01-01 00:00:00", ["count"], {"count": "n"})
    b = features.ingest_features(spark.createDataFrame([("x", 2)], "id string, n bigint"), "id",
                                 "2023-02-01 00:00:00", ["count"], {"count": "n"})
    features.write_feature_table(a, path, "2024-01-01 00:00:00")
    features.write_feature_table(b, path, "2024-01-02 00:00:00")      # the older ingest stays
    features.write_feature_table(b, path, "2024-01-02 00:00:00")      # a replay adds nothing
    table = features.read_feature_table(spark, path)
    assert sorted(r["count"] for r in table.collect()) == [1, 2]
    latest = features.latest_features(table, "2023-03-01 00:00:00").collect()
    assert [(r["entity_id"], r["count"]) for r in latest] == [("x", 2)]
    assert read_source(spark, "parquet", table=path).count() == 2
    assert read_parquet(spark, path).count() == 2


# ---------------------------------------------------------------- L1 / L2 streaming increments
def test_stream_late_older_run_does_not_add_rows(spark):
    from trustfeed.streaming import increments as stream_inc
    root, out, ckpt = (scratch_path(spark, n) for n in ("s-src", "s-out", "s-ckpt"))
    newer = spark.createDataFrame([("p1", "YES", 20230602000000), ("p2", "NO", 20230602000000)],
                                  "post_id string, recommend string, dtime bigint")
    newer.write.partitionBy("dtime").parquet(root)
    schema = spark.read.parquet(root).schema
    stream_inc.run_increment(spark, root, schema, ckpt, out, lambda b: b, dedupe_key="post_id")
    older = spark.createDataFrame([("p1", "NO", 20230601000000), ("p3", "MAYBE", 20230601000000)],
                                  "post_id string, recommend string, dtime bigint")
    older.write.mode("append").partitionBy("dtime").parquet(root)
    stream_inc.run_increment(spark, root, schema, ckpt, out, lambda b: b, dedupe_key="post_id")
    stored = sorted(rows(stream_inc.read_output(spark, out), "post_id", "recommend", "dtime"))
    assert stored == [("p1", "YES", 20230602000000), ("p2", "NO", 20230602000000),
                      ("p3", "MAYBE", 20230601000000)]
    # a third run sees no new files and writes nothing new
    stream_inc.run_increment(spark, root, schema, ckpt, out, lambda b: b, dedupe_key="post_id")
    assert stream_inc.read_output(spark, out).count() == 3


def test_point_in_time_asof_per_feature_carries_non_null(spark):
    hist = spark.createDataFrame([
        ("a", dt.datetime(2023, 1, 1), 1, "x"), ("a", dt.datetime(2023, 2, 1), None, None),
        ("a", dt.datetime(2023, 3, 1), 3, None),
    ], "entity_id string, feature_time timestamp, n int, s string")
    inst = spark.createDataFrame([("a", dt.datetime(2023, 2, 15)), ("a", dt.datetime(2023, 3, 5))],
                                 "e string, timestamp timestamp")
    rowwise = sorted((r["timestamp"].month, r["n"], r["s"])
                     for r in features.point_in_time_asof(inst, [("e", hist, "x")]).collect())
    assert rowwise == [(2, None, None), (3, 3, None)]
    per = sorted((r["timestamp"].month, r["n"], r["s"])
                 for r in features.point_in_time_asof(inst, [("e", hist, "x")], per_feature=True).collect())
    assert per == [(2, 1, "x"), (3, 3, "x")]


def test_capped_sample_retry_path_is_exact(spark):
    data = [(f"p{i}", "hot" if i % 3 == 0 else "cold") for i in range(9000)]
    df = spark.createDataFrame(data, "post_id string, b string")
    caps = {"hot": 40, "cold": 7}
    got = set(r[0] for r in rows(sampling.capped_sample(df, "b", caps, seed="r", oversample=0.5), "post_id"))
    keyed = df.withColumn("u", uniform_u32("post_id", "r")).toPandas()
    expect = set()
    for b, g in keyed.groupby("b"):
        expect |= set(g.sort_values(["u", "post_id"]).head(caps[b])["post_id"])
    assert got == expect


def test_stream_replayed_batch_keeps_its_rows(spark):
    """A batch replayed after its output was written (but not committed) writes the same rows again."""
    from trustfeed.streaming import increments as stream_inc
    root, out, ckpt = (scratch_path(spark, n) for n in ("r-src", "r-out", "r-ckpt"))
    rows_in = spark.createDataFrame([("p1", "YES", 20230602000000), ("p2", "NO", 20230602000000)],
                                    "post_id string, recommend string, dtime bigint")
    rows_in.write.partitionBy("dtime").parquet(root)
    schema = spark.read.parquet(root).schema
    stream_inc.run_increment(spark, root, schema, ckpt, out, lambda b: b, dedupe_key="post_id")
    # simulate the replay: same batch id, same input, its output already on storage
    fresh_ckpt = scratch_path(spark, "r-ckpt2")
    stream_inc.run_increment(spark, root, schema, fresh_ckpt, out, lambda b: b, dedupe_key="post_id")
    stored = sorted(rows(stream_inc.read_output(spark, out), "post_id", "recommend"))
    assert stored == [("p1", "YES"), ("p2", "NO")]


# ---------------------------------------------------------------- round 2: re-runs, switches, training
def test_cluster_without_shared_folder_fails_loudly():
    from trustfeed.session import checkpoint_dir

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_prediction_run_is_replaced_whole(spark):
    root = scratch_path(spark, "preds")
    for label in ("YES", "NO"):
        df = spark.createDataFrame([("p1", label), ("p2", "MAYBE")], "post_id string, recommend string")
        increments.save_predictions(df, root, 20240101000000)
    assert sorted(rows(spark.read.parquet(root), "post_id", "recommend")) == [("p1", "NO"), ("p2", "MAYBE")]


def test_latest_per_post_tie_has_one_winner(spark):
    data = [("p1", 1, "YES"), ("p1", 1, "NO"), ("p1", 0, "MAYBE")]
    got = {tuple(rows(latest_per_post(spark.createDataFrame(data[::o], "post_id string, dtime bigint, recommend string")
                                      .repartition(n))))
           for o in (1, -1) for n in (1, 3)}
    assert len(got) == 1


def test_empty_publish_clears_only_its_strategy(spark):
    table = scratch_path(spark, "feedtab")
    schema = "strategy_name string, post_id string, v double"
    publish_feed(spark.createDataFrame([("s 1", "p1", 0.0)], schema), table, "s 1")
    publish_feed(spark.createDataFrame([("s2", "q1", 0.0)], schema), table, "s2")
    publish_feed(spark.createDataFrame([], schema), table, "s 1")
    assert rows(read_feed(spark, table), "strategy_name", "post_id") == [("s2", "q1")]


def test_cursor_errors_are_raised_and_old_cursor_survives(spark, tmp_path):
    state = f"{tmp_path}/cursor"
    assert increments.load_cursor(spark, state, 7) == 7
    increments.save_cursor(spark.createDataFrame([(42,)], "watermark bigint"), state)
    increments.save_cursor(spark.createDataFrame([(43,)], "watermark bigint"), state)
    assert increments.load_cursor(spark, state, 7) == 43
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"not a parquet file")
    with pytest.raises(Exception):
        increments.load_cursor(spark, f"{tmp_path}/broken", 7)


def test_feature_stage_replayed_after_a_crash_adds_nothing(spark, monkeypatch):
    from trustfeed.plans import stages
    posts, table, state = (scratch_path(spark, n) for n in ("posts", "pfeat", "pstate"))
    post = {c: None for c in schemas.PROFILE_POST.fieldNames()} | {
        "post_id": "p1", "profile_id": "a", "block_timestamp": dt.datetime(2024, 1, 1)}
    increments.write_snapshot(spark.createDataFrame([post], schemas.PROFILE_POST), posts, 20240102000000)
    stats = spark.createDataFrame([], schemas.PUBLICATION_STATS)
    args = (spark, posts, stats, table, state, "2024-01-03 00:00:00")

    def crash(*a, **k):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(stages, "append_record", crash)
        with pytest.raises(OSError):
            stages.post_features_stage(*args)
    assert stages.post_features_stage(*args)
    assert features.read_feature_table(spark, table).count() == 1
    assert not stages.post_features_stage(*args)


def test_exact_split_shares(spark):
    data = [(f"p{i:04d}", ["YES", "NO", "MAYBE", None][min(i % 16, 3)]) for i in range(1001)]
    df = spark.createDataFrame(data, "post_id string, recommend string")
    got = rows(sampling.train_test_split(df).groupBy("recommend").agg(
        F.count(F.lit(1)), F.sum(F.col("is_test").cast("int"))))
    assert all(test == int(n * 0.25 + 0.5) for _, n, test in got) and len(got) == 4


def test_exact_quantiles_match_numpy(spark):
    import numpy as np
    random.seed(9)
    data = [random.choice([0, 0, 0, 1, 5, 9, random.randint(0, 1000)]) for _ in range(2003)]
    df = spark.createDataFrame([(x,) for x in data], "x int").repartition(5)
    assert feed.exact_quantiles(df, "x", ((1, 3), (2, 3))) == pytest.approx(list(np.quantile(data, [1 / 3, 2 / 3])))
    assert feed.exact_quantiles(df.where("x < 0"), "x", ((1, 3),)) == [None]


def test_asof_hot_entity_is_linear(spark):
    """Half of all keys on one entity with many versions, over several time buckets; checked against a plain lookup."""
    random.seed(3)
    t0 = dt.datetime(2024, 1, 1)
    vers = [("hot" if i % 2 else f"e{i % 40}", t0 + dt.timedelta(hours=random.randint(0, 900)), i, None if i % 5 == 0 else i)
            for i in range(1500)]
    inst = [("hot" if i % 2 else f"e{i % 45}", t0 + dt.timedelta(hours=random.randint(-5, 950))) for i in range(1500)]
    table = spark.createDataFrame(vers, "entity_id string, feature_time timestamp, a int, b int") \
        .dropDuplicates(["entity_id", "feature_time"])
    keys = spark.createDataFrame(inst, "e string, timestamp timestamp")
    out = features.point_in_time_asof(keys, [("e", table, "x")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "feature_time" not in plan and "NestedLoop" not in plan
    known = [tuple(r) for r in table.collect()]

    def newest(e, t, i):
        hits = [v for v in known if v[0] == e and v[1] <= t and (i == 2 or v[i] is not None)]
        return max(hits, key=lambda v: v[1]) if hits else None
    for r in out.collect():
        v = newest(r["e"], r["timestamp"], 2)
        assert (r["a"], r["b"]) == ((v[2], v[3]) if v else (None, None))
    for r in features.point_in_time_asof(keys, [("e", table, "x")], per_feature=True).collect():
        v = newest(r["e"], r["timestamp"], 3)
        assert r["b"] == (v[3] if v else None)


def _labelled_rows(spark, n, languages):
    random.seed(11)
    return spark.createDataFrame(
        [(f"p{i:05d}", random.choice(["YES", "NO", "MAYBE"]), i % 50, i % 7, i % 5, i % 3, i % 11, i % 2, i % 100, 0.5, 50, 7, 5, 3,
          random.random(), i % 2 == 0, i % 3 == 0, None, f"l{i % languages}", None, "w", "IMAGE") for i in range(n)],
        "post_id string, recommend string, age bigint, mirrors bigint, collects bigint, comments bigint, upvotes bigint, "
        "downvotes bigint, followship_rank bigint, followship_score double, max_age bigint, max_mirrors bigint, "
        "max_collects bigint, max_comments bigint, post_score double, is_original boolean, is_content_warning boolean, "
        "custom_filters_gardener_flagged boolean, language string, region string, content_warning string, "
        "main_content_focus string")


@pytest.mark.parametrize("kind,size", [("rf", {"num_trees": 3, "max_depth": 3}), ("gbt", {"max_iter": 2, "max_depth": 2})])
def test_training_with_many_languages(spark, kind, size):
    df = _labelled_rows(spark, 600, 300)
    m = model.train(df, kind, partition_rows=300, **size)
    assert model.predict(m, df).count() == 600
    importance = dict(model.feature_importance(m))
    assert set(importance) == set(model.build_pipeline(kind)[1])
    assert sum(importance.values()) == pytest.approx(1.0, abs=1e-6)
    assert [c for _, c in model.label_codes(m)] == [0, 1, 2]
    if kind == "gbt":
        losses = model.boosting_losses(m, df, every=1)
        assert len(losses) == 6 and all(x > 0 for _, _, x in losses)


def test_model_does_not_depend_on_input_partitions(spark):
    df = _labelled_rows(spark, 600, 5)
    got = []
    for n in (4, 8):
        m = model.train(df.repartition(n), "rf", num_trees=5, max_depth=4)
        got.append(sorted(rows(model.predict(m, df))))
    assert got[0] == got[1]


def test_metrics_equal_a_plain_computation(spark):
    df = _labelled_rows(spark, 300, 5)
    m = model.train(df, "rf", num_trees=3, max_depth=3)
    scored = [(r["recommend"], r["predicted"], r["p_true"]) for r in model.scored_rows(m, df).collect()]
    got = model.evaluate(m, df)
    import math
    n = len(scored)
    assert got["accuracy"] == pytest.approx(sum(a == p for a, p, _ in scored) / n)
    assert got["logLoss"] == pytest.approx(sum(-math.log(max(p, 1e-15)) for _, _, p in scored) / n)
    f1 = 0.0
    for c in ("YES", "NO", "MAYBE"):
        actual = sum(a == c for a, _, _ in scored)
        guessed = sum(p == c for _, p, _ in scored)
        f1 += actual / n * 2 * sum(a == c == p for a, p, _ in scored) / (actual + guessed)
    assert got["f1"] == pytest.approx(f1)


@pytest.mark.parametrize("bits", [0, 2, 16])
def test_split_cuts_inside_a_cell(spark, monkeypatch, bits):
    """Exact shares and the plain order of draws with few cells and many, repeated and null keys; the wide rows are not sorted."""
    monkeypatch.setattr(sampling, "SPLIT_CELL_BITS", bits)
    data = [(f"p{i // 2}" if i % 3 else None if i % 2 else f"q{i}", ["YES", "NO", None][i % 3] if i else "ONE", i) for i in range(400)]
    out = sampling.train_test_split(spark.createDataFrame(data, "post_id string, recommend string, n int"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [" not in plan
    got = rows(out, "recommend", "post_id", "n", "is_test")
    assert sorted(r[2] for r in got) == list(range(400))

    def draw(key):
        import hashlib
        return (0, 0, "") if key is None else (1, int(hashlib.md5((key + "1").encode()).hexdigest()[:8], 16), key)
    for label in ("YES", "NO", None, "ONE"):
        part = sorted((draw(key), test) for lab, key, _, test in got if lab == label)
        tests = (len(part) + 2) // 4
        assert sum(t for _, t in part) == tests
        assert all(d <= part[tests - 1][0] for d, t in part if t) and all(d >= part[max(tests - 1, 0)][0] for d, t in part if not t)


def test_boosted_partitions_stay_few():
    assert [model.training_partitions(n, "gbt") for n in (0, 20_001, 640_000, 5_400_000, 40_000_000)] == [1, 2, 32, 32, 160]
    assert [model.training_partitions(n, "rf") for n in (0, 20_001, 5_400_000)] == [1, 2, 270]


@pytest.mark.parametrize("per_feature", [False, True])
def test_asof_writes_only_pieces_with_keys(spark, monkeypatch, per_feature):
    """Of many old versions, those are carried on that a key asks for; entities without versions carry nothing."""
    t0, written = dt.datetime(2024, 1, 1), {}
    vers = [(f"e{e}", t0 + dt.timedelta(days=d), None if d == 29 else e * 100 + d) for e in range(5) for d in range(30)]
    table = spark.createDataFrame(vers, "entity_id string, feature_time timestamp, a int")
    keys = spark.createDataFrame([(e, t0 + dt.timedelta(days=40)) for e in ("e0", "e3", "none")], "e string, timestamp timestamp")

    def write(df, name="stage"):
        out = materialize(df, name)
        written[name] = out.count()
        return out
    materialize = features.materialize
    monkeypatch.setattr(features, "materialize", write)
    got = dict(rows(features.point_in_time_asof(keys, [("e", table, "x")], per_feature=per_feature), "e", "a"))
    assert got == ({"e0": 28, "e3": 328, "none": None} if per_feature else {"e0": None, "e3": None, "none": None})
    assert written["asof-carried"] == 2
