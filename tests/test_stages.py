"""The online stages end to end over written tables, with cursors."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from trustfeed.operators.model import load_model
from trustfeed.params import FeedParams
from trustfeed.plans import chain, stages
from trustfeed.session import scratch_path
from trustfeed.sources.driver_tables import SourceTables


def test_stages_end_to_end(spark):
    src = SourceTables(spark, SF_SMALL)
    posts = src.profile_post()
    total = posts.count()
    p = {n: scratch_path(spark, n) for n in ("posts", "xstate", "pfeat", "fstate", "prof", "models",
                                              "preds", "pstate", "feed")}

    # extract: an older source state, then the grown source, then nothing new
    first = stages.extract_increment(spark, posts.where(F.year("block_timestamp") <= 1995), p["posts"],
                                     p["xstate"], 20230516000000, initial="1990-01-01 00:00:00")
    second = stages.extract_increment(spark, posts, p["posts"], p["xstate"], 20230517000000)
    assert first and second
    assert stages.extract_increment(spark, posts, p["posts"], p["xstate"], 20230518000000) is None
    runs = spark.read.parquet(p["posts"])
    assert runs.count() == total and runs.select("post_id").distinct().count() == total

    # features and trust
    ft = chain.FIXTURE_FEATURE_TIME
    assert stages.post_features_stage(spark, p["posts"], src.publication_stats(), p["pfeat"], p["fstate"], ft,
                                      posts_ledger=p["xstate"])
    assert not stages.post_features_stage(spark, p["posts"], src.publication_stats(), p["pfeat"], p["fstate"], ft,
                                          posts_ledger=p["xstate"])
    stages.trust_features_stage(src.globaltrust(), src.profile(), p["prof"], ft)

    # the stage flow scores posts exactly like the in-memory chain
    got = {r["post_id"]: r["post_score"] for r in
           stages.scored_instances(spark, runs, p["pfeat"], p["prof"], "2024-01-05 00:00:00").collect()}
    want = {r["post_id"]: r["post_score"] for r in chain.scored_posts(src).collect()}
    assert got == want

    # offline training, then predictions for new posts, then nothing new
    path = stages.train_stage(chain.labelled_posts(src), p["models"], "v1", num_trees=5, max_depth=4)
    model = load_model(p["models"], "v1")
    assert path.endswith("/v1")
    out = stages.prediction_stage(spark, p["posts"], p["pfeat"], p["prof"], model, p["preds"], p["pstate"],
                                  20240131120000, "2024-01-05 00:00:00", posts_ledger=p["xstate"])
    assert out is not None
    preds = spark.read.parquet(p["preds"])
    assert preds.count() == total
    assert {r[0] for r in preds.select("recommend").distinct().collect()} <= {"YES", "MAYBE", "NO"}
    assert stages.prediction_stage(spark, p["posts"], p["pfeat"], p["prof"], model, p["preds"], p["pstate"],
                                   20240131130000, "2024-01-05 00:00:00", posts_ledger=p["xstate"]) is None

    # feed over all prediction runs
    feed = stages.feed_stage(spark, p["preds"], "2024-02-01 00:00:00", p["feed"], FeedParams(),
                             predictions_ledger=p["pstate"])
    v = sorted(r["v"] for r in feed.collect())
    assert 0 < len(v) <= FeedParams().feed_size
    assert v == [float(i) for i in range(len(v))]
