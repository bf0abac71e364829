"""The online stages as functions over storage paths.

Each stage reads its inputs (increments past its own cursor, feature tables,
model), runs the operators, writes its output and then commits output and
cursor together as one record of its run ledger (``sources.ledger``): what a
crashed run wrote counts for nothing, and the next run, under whatever id, takes
the same increment. ``state_path`` is the stage's ledger; stages that read runs
of another one are given that one's. A scheduler calls them in order:

    extract_increment -> post_features_stage -> trust_features_stage
    -> prediction_stage -> feed_stage        (train_stage offline)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustfeed.operators.features import (POST_FEATURES, PROFILE_FEATURES, ingest_features,
                                          point_in_time, read_feature_table, write_feature_table)
from trustfeed.operators.feed import fill_nulls, generate_feed
from trustfeed.operators.model import predict, save_model, train
from trustfeed.operators.posts import post_feature_frame, post_flags, posts_with_stats
from trustfeed.operators.publish import publish_feed, read_feed
from trustfeed.operators.scoring import author_maxima, with_post_score
from trustfeed.operators.trust import trust_rank
from trustfeed.params import (DEFAULT_EXTRACT_WATERMARK, DEFAULT_PARTITION_WATERMARK, TRUST_STRATEGY,
                              FeedParams)
from trustfeed.sources.increments import has_rows, next_watermark, read_increment, save_predictions
from trustfeed.sources.ledger import append_record, ingest_run, ledger_cursor, live_records, needed, read_runs

PREDICTION_KEEP = ["post_id", "profile_id", "is_original", "is_content_warning",
                   "custom_filters_gardener_flagged", "language", "region", "content_warning",
                   "main_content_focus", "age", "upvotes", "downvotes", "mirrors", "comments", "collects",
                   "followship_rank", "followship_score", "post_score"]


def extract_increment(spark: SparkSession, source: DataFrame, root: str, state_path: str, run_dtime: int,
                      cursor_col: str = "block_timestamp", initial=DEFAULT_EXTRACT_WATERMARK) -> str | None:
    """Rows newer than the ledger's cursor go to ``root/dtime=<run>``.

    Returns the run path, or None when there is nothing new.
    """
    return ingest_run(spark, source, root, state_path, run_dtime, cursor_col, initial)


def new_runs(spark: SparkSession, root: str, ledger: str | None, after: int) -> DataFrame | None:
    """A4: rows of the runs past ``after``, or None; without a ledger, of all directories there are."""
    if ledger is None:
        rows = read_increment(spark, root, after)
        return rows if has_rows(rows) else None
    live = live_records(spark, ledger)
    return read_runs(spark, root, ledger, after) if needed(live, after) else None


def post_features_stage(spark: SparkSession, posts_root: str, stats: DataFrame, feature_table: str,
                        state_path: str, feature_time, initial=DEFAULT_PARTITION_WATERMARK,
                        posts_ledger: str | None = None) -> bool:
    """A4 + B2/B3/C1 + A11: post runs past the cursor -> post features appended
    to the feature table at ``feature_time``."""
    cursor = ledger_cursor(spark, state_path, initial, "bigint")
    posts = new_runs(spark, posts_root, posts_ledger, cursor)
    if posts is None:
        return False
    feats = post_feature_frame(posts_with_stats(post_flags(posts, feature_time), stats))
    write_feature_table(ingest_features(feats, "post_id", feature_time, POST_FEATURES), feature_table, feature_time)
    last = next_watermark(posts, "dtime").first()[0]
    append_record(spark, state_path, last, feature_table, after=cursor, high=last)
    return True


def trust_features_stage(globaltrust: DataFrame, profile: DataFrame, feature_table: str, feature_time,
                         strategy=TRUST_STRATEGY) -> None:
    """E1 + A11: rank/score of the newest snapshot appended as profile features."""
    ranked = trust_rank(globaltrust, profile, strategy)
    write_feature_table(ingest_features(ranked, "profile_id", feature_time, PROFILE_FEATURES,
                                        {"followship_rank": "rank", "followship_score": "score"}),
                        feature_table, feature_time)


def scored_instances(spark: SparkSession, posts: DataFrame, post_table: str, profile_table: str,
                     lookup_time, start_time=None) -> DataFrame:
    """A12 + C5/D2 + H1: features as of ``lookup_time`` for the given posts,
    per-author maxima and post score."""
    inst = posts.select(F.col("post_id").alias("entity_type_posts"),
                        F.col("profile_id").alias("entity_type_profiles"))
    feats = point_in_time(inst, [("entity_type_posts", read_feature_table(spark, post_table), "posts"),
                                 ("entity_type_profiles", read_feature_table(spark, profile_table),
                                  "profiles")],
                          lookup_time, start_time)
    feats = feats.drop("profile_id").withColumnRenamed("entity_type_posts", "post_id") \
        .withColumnRenamed("entity_type_profiles", "profile_id")
    return with_post_score(author_maxima(feats))


def train_stage(labelled: DataFrame, model_root: str, version: str, classifier: str = "rf", **kw) -> str:
    """J1-J4 + A13: fit on labelled rows and save one versioned model."""
    return save_model(train(labelled, classifier, **kw), model_root, version)


def prediction_stage(spark: SparkSession, posts_root: str, post_table: str, profile_table: str, model,
                     out_root: str, state_path: str, run_dtime: int, lookup_time, start_time=None,
                     initial=DEFAULT_PARTITION_WATERMARK, posts_ledger: str | None = None) -> str | None:
    """A4 + A12 + H1 + J5 + B10 + A9: new posts -> predicted labels, written to
    ``out_root/dtime=<run>/recommend=<label>``."""
    cursor = ledger_cursor(spark, state_path, initial, "bigint")
    posts = new_runs(spark, posts_root, posts_ledger, cursor)
    if posts is None:
        return None
    scored = scored_instances(spark, posts, post_table, profile_table, lookup_time, start_time)
    preds = fill_nulls(predict(model, scored, keep=PREDICTION_KEEP).drop("prediction"), skip=("recommend",))
    path = save_predictions(preds, out_root, run_dtime)
    append_record(spark, state_path, run_dtime, path, after=cursor, high=next_watermark(posts, "dtime").first()[0])
    return path


def feed_stage(spark: SparkSession, predictions_root: str, now, feed_table: str,
               params: FeedParams = FeedParams(), predictions_ledger: str | None = None) -> DataFrame:
    """A7 + the feed chain + A10: every prediction run (newest per post) ->
    ranked feed published for ``params.strategy_name``."""
    preds = spark.read.parquet(predictions_root) if predictions_ledger is None else \
        read_runs(spark, predictions_root, predictions_ledger)
    feed = generate_feed(preds, now, params)
    publish_feed(feed, feed_table, params.strategy_name)
    return read_feed(spark, feed_table).where(F.col("strategy_name") == params.strategy_name)
