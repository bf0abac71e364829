"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables of ``sf_dir`` (or data Spark derives from
them) in full. Parameters that fit the driver tables are in ``plans.chain``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustfeed.operators import boosting, feed, features, model, publish, quality, sampling, views
from trustfeed.functions.columns import dtime_to_timestamp, uniform_u32
from trustfeed.operators.dedupe import dedupe_by_key, duplicate_keys, latest_per_post
from trustfeed.operators.running_maxima import RunningScores
from trustfeed.operators.sampling import weighted_sample
from trustfeed import schemas
from trustfeed.operators.posts import format_timestamp, post_flags, posts_with_stats
from trustfeed.operators.scoring import top_posts
from trustfeed.operators.validity import FeatureIntervals
from trustfeed.operators.trust import latest_snapshot, post_author_trust, profile_trust_by_handle
from trustfeed.params import LABELS, STRATIFIED_TARGETS, FeedParams, LabelParams
from trustfeed.plans import chain
from trustfeed.session import materialize, scratch_path
from trustfeed.sources import increments, ledger
from trustfeed.streaming import increments as stream_inc
from trustfeed.sources.driver_tables import SourceTables

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


def _src(spark: SparkSession, sf_dir: str) -> SourceTables:
    return SourceTables(spark, sf_dir)


# ------------------------------------------------------------ trust
@register("latest_trust_snapshot")
def q_latest_trust_snapshot(spark, sf_dir):
    return latest_snapshot(_src(spark, sf_dir).globaltrust())


@register("trust_rank")
def q_trust_rank(spark, sf_dir):
    return chain.ranked_profiles(_src(spark, sf_dir))


# ---------------------------------------------------- post features
@register("post_flags")
def q_post_flags(spark, sf_dir):
    return post_flags(_src(spark, sf_dir).profile_post(), chain.FIXTURE_FEATURE_TIME)


@register("posts_with_stats")
def q_posts_with_stats(spark, sf_dir):
    src = _src(spark, sf_dir)
    return posts_with_stats(post_flags(src.profile_post(), chain.FIXTURE_FEATURE_TIME),
                            src.publication_stats())


# ------------------------------------------------ score and labels
@register("author_maxima")
def q_author_maxima(spark, sf_dir):
    return chain.scored_posts(_src(spark, sf_dir), columns=()).select(
        "post_id", "followship_rank", "max_age", "max_mirrors", "max_collects", "max_comments")


@register("post_score")
def q_post_score(spark, sf_dir):
    return chain.scored_posts(_src(spark, sf_dir), columns=("followship_score",)).select(*chain.score_columns())


# Increments by the posts' age in days, oldest first.
SCORE_INCREMENTS = ((3100, 100000), (2600, 3100), (1900, 2600), (-100000, 1900))


@register("post_score_incremental")
def q_post_score_incremental(spark, sf_dir):
    """The scores after all posts came in four increments."""
    posts = materialize(chain.posts_with_trust(_src(spark, sf_dir), columns={*chain.SCORE_INPUTS, "followship_score"}), "features")
    running = RunningScores(spark, scratch_path(spark, "running-scores"), posts.schema)
    for n, (low, high) in enumerate(SCORE_INCREMENTS):
        running.add(n, posts.where((F.col("age") > low) & (F.col("age") <= high) | (F.col("age").isNull() & F.lit(n == 0))))
    return running.current().select(*chain.score_columns())


@register("top_posts")
def q_top_posts(spark, sf_dir):
    p = chain.FIXTURE_LABELS
    return top_posts(chain.scored_posts(_src(spark, sf_dir), columns=("followship_score",)), p.yes_rank, p.top_k) \
        .select(*chain.score_columns())


@register("heuristic_labels")
def q_heuristic_labels(spark, sf_dir):
    return chain.labelled_posts(_src(spark, sf_dir), columns=()).select(
        "post_id", "followship_rank", "post_score", "recommend")


@register("heuristic_labels_production")
def q_heuristic_labels_production(spark, sf_dir):
    """The labels by the production thresholds."""
    return chain.labelled_posts(_src(spark, sf_dir), params=LabelParams(), columns=()).select(
        "post_id", "followship_rank", "post_score", "recommend")


# ------------------------------------------------------------- views (K1-K7)
@register("view_collects")
def q_view_collects(spark, sf_dir):
    src = _src(spark, sf_dir)
    return views.view_collects(src.collected_records(), src.profile())


@register("view_comments")
def q_view_comments(spark, sf_dir):
    return views.view_comments(_src(spark, sf_dir).post_comment())


@register("view_follows")
def q_view_follows(spark, sf_dir):
    src = _src(spark, sf_dir)
    return views.view_follows(src.follower(), src.profile())


@register("view_mirrors")
def q_view_mirrors(spark, sf_dir):
    return views.view_mirrors(_src(spark, sf_dir).profile_post())


@register("view_posts")
def q_view_posts(spark, sf_dir):
    return views.view_posts(_src(spark, sf_dir).profile_post())


@register("view_profiles")
def q_view_profiles(spark, sf_dir):
    return views.view_profiles(_src(spark, sf_dir).profile())


@register("view_follow_counts")
def q_view_follow_counts(spark, sf_dir):
    src = _src(spark, sf_dir)
    return views.view_follow_counts(src.follower(), src.profile())


# ------------------------------------------------- collect samples
@register("collected_posts")
def q_collected_posts(spark, sf_dir):
    src = _src(spark, sf_dir)
    return views.collected_posts(src.publication_stats(), src.profile_post())


@register("collect_currency")
def q_collect_currency(spark, sf_dir):
    src = _src(spark, sf_dir)
    return views.collect_currency(src.collect_module_details(), src.profile_post())


# ------------------------------------------------ quality
@register("label_counts")
def q_label_counts(spark, sf_dir):
    return quality.value_counts(chain.labelled_posts(_src(spark, sf_dir), columns=()), "recommend")


@register("duplicate_keys")
def q_duplicate_keys(spark, sf_dir):
    # wallets that own more than one profile (the fan-out of the wallet joins)
    return duplicate_keys(_src(spark, sf_dir).profile(), ["owned_by"])


@register("rank_range")
def q_rank_range(spark, sf_dir):
    return quality.rank_range(chain.posts_with_trust(_src(spark, sf_dir), columns=("followship_rank",)))


@register("column_profile")
def q_column_profile(spark, sf_dir):
    return quality.column_profile(chain.scored_posts(_src(spark, sf_dir), columns=("followship_score",)).select(*chain.score_columns()))


@register("id_lookup")
def q_id_lookup(spark, sf_dir):
    # profiles looked up by the ids that follow events point at
    src = _src(spark, sf_dir)
    return quality.id_lookup(views.view_profiles(src.profile()),
                             src.follower().select("follow_profile_id"), key="profile_id")


@register("unlabelled_posts")
def q_unlabelled_posts(spark, sf_dir):
    return quality.unlabelled(chain.labelled_posts(_src(spark, sf_dir), columns=())).select(
        "post_id", "followship_rank", "post_score")


@register("table_sizes")
def q_table_sizes(spark, sf_dir):
    return quality.table_sizes(spark, sf_dir)


# --------------------------------------------------- feed
def _history(spark, sf_dir):
    return chain.prediction_history(_src(spark, sf_dir))


def _eligible(spark, sf_dir):
    return feed.current_eligible(_history(spark, sf_dir))


@register("fill_nulls")
def q_fill_nulls(spark, sf_dir):
    return chain.current_predictions(_src(spark, sf_dir))


@register("latest_per_post")
def q_latest_per_post(spark, sf_dir):
    return latest_per_post(_history(spark, sf_dir).select("post_id", "dtime", "recommend"))


@register("engagement_score")
def q_engagement_score(spark, sf_dir):
    return chain.current_predictions(_src(spark, sf_dir), chain.FEED_INPUTS).select(
        "post_id", feed.engagement_expr().alias("engagement_score"))


@register("feed_eligible")
def q_feed_eligible(spark, sf_dir):
    return _eligible(spark, sf_dir)


@register("recency_bucket")
def q_recency_bucket(spark, sf_dir):
    return feed.recency_bucket(_eligible(spark, sf_dir), chain.FEED_NOW, FeedParams().buckets)


@register("recency_bucket_packed")
def q_recency_bucket_packed(spark, sf_dir):
    return feed.recency_bucket(_eligible(spark, sf_dir), chain.FEED_NOW, FeedParams().buckets, mode="packed")


@register("bucket_counts")
def q_bucket_counts(spark, sf_dir):
    b = feed.recency_bucket(_eligible(spark, sf_dir), chain.FEED_NOW, FeedParams().buckets)
    return quality.value_counts(b, "time_ago")


@register("capped_bucket_sample")
def q_capped_bucket_sample(spark, sf_dir):
    return feed.sampled_candidates(_history(spark, sf_dir), chain.FEED_NOW, FeedParams())


@register("popularity_bins")
def q_popularity_bins(spark, sf_dir):
    return feed.popularity_bins(feed.sampled_candidates(_history(spark, sf_dir), chain.FEED_NOW, FeedParams()))


@register("popularity_cut_points")
def q_popularity_cut_points(spark, sf_dir):
    return feed.popularity_cut_points(
        feed.sampled_candidates(_history(spark, sf_dir), chain.FEED_NOW, FeedParams()))


@register("feed_weights")
def q_feed_weights(spark, sf_dir):
    return feed.weighted_candidates(_history(spark, sf_dir), chain.FEED_NOW, FeedParams())


@register("feed_weights_v1")
def q_feed_weights_v1(spark, sf_dir):
    return feed.weighted_candidates(_history(spark, sf_dir), chain.FEED_NOW,
                                    FeedParams(weight_profile="v1"))


@register("weighted_feed_sample")
def q_weighted_feed_sample(spark, sf_dir):
    p = FeedParams()
    w = feed.weighted_candidates(_history(spark, sf_dir), chain.FEED_NOW, p)
    return weighted_sample(w, "weights", p.feed_size, seed=p.seed + "-w")


@register("feed_ranked")
def q_feed_ranked(spark, sf_dir):
    return feed.generate_feed(_history(spark, sf_dir), chain.FEED_NOW, FeedParams())


@register("feed_ranked_recent")
def q_feed_ranked_recent(spark, sf_dir):
    return feed.generate_feed(_history(spark, sf_dir), chain.FEED_NOW, FeedParams.prototype(), order="recent")


# ------------------------------------------------- feature store
@register("feature_ingest_posts")
def q_feature_ingest_posts(spark, sf_dir):
    return chain.post_feature_ingest(_src(spark, sf_dir))


@register("feature_ingest_profiles")
def q_feature_ingest_profiles(spark, sf_dir):
    return chain.profile_feature_ingest(_src(spark, sf_dir), feature_time=chain.FIXTURE_FEATURE_TIME)


@register("point_in_time_features")
def q_point_in_time_features(spark, sf_dir):
    src = _src(spark, sf_dir)
    return features.point_in_time(
        chain.lookup_instances(src),
        [("entity_type_posts", chain.post_feature_history(src), "posts"),
         ("entity_type_profiles", chain.profile_feature_history(src), "profiles")],
        chain.LOOKUP_TIME, chain.LOOKUP_START)


@register("point_in_time_asof")
def q_point_in_time_asof(spark, sf_dir):
    src = _src(spark, sf_dir)
    return features.point_in_time_asof(
        chain.lookup_instances(src, per_row_time=True),
        [("entity_type_posts", chain.post_feature_history(src), "posts"),
         ("entity_type_profiles", chain.profile_feature_history(src), "profiles")],
        "timestamp", chain.LOOKUP_START)


@register("feature_intervals")
def q_feature_intervals(spark, sf_dir):
    """A11/A12/C12 from tables of validity intervals: both ingests of each kind close the one before."""
    src = _src(spark, sf_dir)
    out = chain.lookup_instances(src, per_row_time=True)
    for column, history, times in (
            ("entity_type_posts", chain.post_feature_history(src), chain.POST_INGEST_TIMES),
            ("entity_type_profiles", chain.profile_feature_history(src), chain.PROFILE_SNAPSHOTS)):
        table = FeatureIntervals(spark, [f for f in history.schema if f.name not in (features.ENTITY, features.FEATURE_TIME)])
        for t in times:
            table.ingest(history.where(F.col(features.FEATURE_TIME) == F.lit(t).cast("timestamp")), t)
        out = table.lookup(out, column, "timestamp", chain.LOOKUP_START)
    return out


# --------------------------------------------- increments, cursors, CSV
INCREMENT_WATERMARK = "1996-06-30 00:00:00"


@register("incremental_extract")
def q_incremental_extract(spark, sf_dir):
    return increments.incremental_extract(_src(spark, sf_dir).profile_post(), INCREMENT_WATERMARK)


@register("next_watermark")
def q_next_watermark(spark, sf_dir):
    inc = increments.incremental_extract(_src(spark, sf_dir).profile_post(), INCREMENT_WATERMARK)
    return increments.next_watermark(inc)


@register("increment_read")
def q_increment_read(spark, sf_dir):
    """Posts written as yearly runs dtime=YYYY0101000000, read back past 1996."""
    posts = views.view_posts(_src(spark, sf_dir).profile_post())
    root = scratch_path(spark, "runs")
    runs = posts.withColumn("dtime", (F.year("created_at").cast("bigint") * F.lit(10 ** 10)
                                      + F.lit(101000000)).cast("bigint"))
    runs.write.mode("overwrite").partitionBy("dtime").parquet(root)
    return increments.read_increment(spark, root, 19960101000000)


# States of the source at which the runs are taken; after the second, a run's rows are written but not committed.
LEDGER_RUNS = ((19960101000000, "1995-12-31 23:59:59"), (19980101000000, "1997-12-31 23:59:59"), (19990101000000, "1998-12-31 23:59:59"),
               (20020101000000, "2100-01-01 00:00:00"))


def _ledgered(spark, sf_dir) -> tuple[str, str]:
    """Posts taken in four runs; another one crashed between writing its rows and its commit."""
    posts = views.view_posts(_src(spark, sf_dir).profile_post())
    root, state = scratch_path(spark, "ledger-runs"), scratch_path(spark, "ledger")
    for n, (run, until) in enumerate(LEDGER_RUNS):
        ledger.ingest_run(spark, posts.where(F.col("created_at") <= F.lit(until).cast("timestamp")), root, state, run, "created_at",
                          "1900-01-01 00:00:00")
        if n == 1:
            increments.write_snapshot(posts, root, run + 1)
    return root, state


@register("run_ledger")
def q_run_ledger(spark, sf_dir):
    """The committed runs with their rows and cursors."""
    _, state = _ledgered(spark, sf_dir)
    cols = [F.col(c).cast("timestamp").alias(c) for c in ("after", "low", "high")]
    return ledger.records(spark, state).select("run", "rows", *cols)


@register("committed_runs")
def q_committed_runs(spark, sf_dir):
    """Rows of the committed runs past the first, small ones put together."""
    root, state = _ledgered(spark, sf_dir)
    largest = max(r["rows"] for r in ledger.live_records(spark, state)) + 1
    ledger.compact_runs(spark, root, state, largest, 2 * largest)
    return ledger.read_runs(spark, root, state, LEDGER_RUNS[0][0])


@register("csv_multiline_roundtrip")
def q_csv_multiline_roundtrip(spark, sf_dir):
    """Document texts (quotes, line breaks) through the CSV export and back."""
    docs = _src(spark, sf_dir).raw("documents").select("doc_id", "text", "lang", "source")
    path = scratch_path(spark, "csv")
    increments.write_csv_export(docs, path)
    return increments.read_csv_export(spark, path, docs.schema, increments.CSV_NULL)


# ------------------------------------------------------- de-duplication, joins
@register("dedupe_handles")
def q_dedupe_handles(spark, sf_dir):
    return dedupe_by_key(chain.ranked_profiles(_src(spark, sf_dir)), ["profile_handle"],
                         ["rank", "profile_id"])


@register("dedupe_owners")
def q_dedupe_owners(spark, sf_dir):
    """One profile per wallet: the best ranked, unranked last, then id."""
    src = _src(spark, sf_dir)
    ranked = chain.ranked_profiles(src).select("profile_id", "rank")
    prof = src.profile().join(ranked, "profile_id", "left").select(
        "owned_by", "profile_id", "handle", F.coalesce("rank", F.lit(10 ** 12)).alias("rank_or_last"))
    return dedupe_by_key(prof, ["owned_by"], ["rank_or_last", "profile_id"])


@register("profile_trust_by_handle")
def q_profile_trust_by_handle(spark, sf_dir):
    src = _src(spark, sf_dir)
    return profile_trust_by_handle(src.profile(), chain.ranked_profiles(src)).select(
        "profile_id", "handle", "rank", "score", "trust_profile_id")


@register("post_author_trust")
def q_post_author_trust(spark, sf_dir):
    src = _src(spark, sf_dir)
    return post_author_trust(views.view_posts(src.profile_post()), chain.ranked_profiles(src)) \
        .select("post_id", "profile_id", "rank", "score")


# ------------------------------------------------- samples and model
@register("uniform_sample")
def q_uniform_sample(spark, sf_dir):
    return sampling.uniform_sample(views.view_posts(_src(spark, sf_dir).profile_post()), 100)


@register("train_test_split")
def q_train_test_split(spark, sf_dir):
    return chain.split_labels(_src(spark, sf_dir)).where(F.col("recommend").isNotNull()) \
        .select("post_id", "recommend", "is_test")


@register("stratified_sample")
def q_stratified_sample(spark, sf_dir):
    lab = chain.labelled_posts(_src(spark, sf_dir), columns=()).select("post_id", "recommend", "post_score")
    return sampling.stratified_sample(lab, "recommend", STRATIFIED_TARGETS, seed="0")


@register("label_encoding")
def q_label_encoding(spark, sf_dir):
    # the codes of the encoder that training fits
    rows = chain.labelled_posts(_src(spark, sf_dir), columns=()).where(F.col("recommend").isNotNull())
    fitted = model.label_indexer().fit(materialize(rows.select("recommend"), "labels"))
    return spark.createDataFrame([(label, i) for i, label in enumerate(fitted.labels)], "recommend string, code bigint")


@register("predict_labels")
def q_predict_labels(spark, sf_dir):
    return chain.model_predictions(_src(spark, sf_dir)).select("post_id", "recommend", "dtime")


@register("predict_labels_gbt")
def q_predict_labels_gbt(spark, sf_dir):
    return chain.model_predictions(_src(spark, sf_dir), "gbt") \
        .select("post_id", "recommend", "dtime")


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    m, _ = chain.trained_model(_src(spark, sf_dir))
    return spark.createDataFrame(model.feature_importance(m), "feature string, importance double")


@register("model_metrics")
def q_model_metrics(spark, sf_dir):
    return _metric_rows(spark, *chain.trained_model(_src(spark, sf_dir)))


def _metric_rows(spark, m, tf: DataFrame) -> DataFrame:
    by = model.evaluate_by(m, tf)
    rows = [(split, k, v) for split, test in (("train", False), ("test", True)) for k, v in by[test].items()]
    return spark.createDataFrame(rows, "split string, metric string, value double")


def _splits(tf: DataFrame):
    return (("train", tf.where(~F.col("is_test"))), ("test", tf.where(F.col("is_test"))))


@register("model_metrics_without_rule_columns")
def q_model_metrics_without_rule_columns(spark, sf_dir):
    """Metrics of a model that doesn't see the columns the labels were made from."""
    return _metric_rows(spark, *chain.trained_model(_src(spark, sf_dir), leaky=False))


@register("boosting_losses")
def q_boosting_losses(spark, sf_dir):
    """Loss of the boosted model on training and test rows during training."""
    m, tf = chain.trained_model(_src(spark, sf_dir), "gbt")
    rows = [(split, *x) for split, part in _splits(tf) for x in model.boosting_losses(m, part)]
    return spark.createDataFrame(rows, "split string, label string, round int, loss double")


# joint softmax boosting: all rounds, and a short run that the SQL repeats
SHORT_BOOST = boosting.BoostParams(rounds=2, depth=2, loss_every=1)


def _boosted(spark, sf_dir, params):
    tf = chain.training_frame(_src(spark, sf_dir))
    return (*boosting.train_softmax(tf, params), tf)


@register("softmax_losses")
def q_softmax_losses(spark, sf_dir):
    """Log loss on both splits every 10 of 100 rounds, from the written margins."""
    m, _, _ = _boosted(spark, sf_dir, boosting.BoostParams())
    return spark.createDataFrame(m.losses, "split string, round int, loss double")


@register("softmax_losses_short")
def q_softmax_losses_short(spark, sf_dir):
    m, _, _ = _boosted(spark, sf_dir, SHORT_BOOST)
    return spark.createDataFrame(m.losses, "split string, round int, loss double")


@register("softmax_split_counts")
def q_softmax_split_counts(spark, sf_dir):
    """Splits, gain and cover per feature, from the node table."""
    m, _, _ = _boosted(spark, sf_dir, SHORT_BOOST)
    return boosting.split_counts(materialize(boosting.node_table(spark, m), "nodes"))


@register("softmax_confusion")
def q_softmax_confusion(spark, sf_dir):
    """Predicted against true labels of the test rows."""
    m, _, tf = _boosted(spark, sf_dir, SHORT_BOOST)
    test = tf.where(F.col("is_test") & F.col("recommend").isNotNull()).withColumnRenamed("recommend", "actual")
    return boosting.predict_softmax(m, test, ["actual"]).groupBy("actual", F.col("recommend").alias("predicted")).count()


@register("predict_labels_softmax")
def q_predict_labels_softmax(spark, sf_dir):
    """Every post with the label that the boosted model of 100 rounds predicts."""
    m, _, tf = _boosted(spark, sf_dir, boosting.BoostParams())
    return boosting.predict_softmax(m, tf, ["post_id"]).select("post_id", "recommend")


@register("confusion_totals")
def q_confusion_totals(spark, sf_dir):
    """Row sums of the confusion matrix: test rows per true label."""
    m, tf = chain.trained_model(_src(spark, sf_dir))
    return model.confusion(m, tf.where(F.col("is_test"))).groupBy("actual").agg(F.sum("count").alias("rows"))


@register("prediction_totals")
def q_prediction_totals(spark, sf_dir):
    """Sum of the prediction histogram, and predictions outside the label set."""
    h = quality.value_counts(chain.model_predictions(_src(spark, sf_dir)), "recommend", keep_null=True)
    known = F.coalesce(F.col("recommend").isin(*LABELS), F.lit(False))
    return h.agg(F.sum("count").alias("posts"), F.sum(F.when(known, 0).otherwise(F.col("count"))).alias("unknown"))


@register("predicted_label_sample")
def q_predicted_label_sample(spark, sf_dir):
    """Unlabelled posts -> predicted labels -> joined back to the posts -> sample per predicted label."""
    return sampling.stratified_sample(chain.predicted_unlabelled(_src(spark, sf_dir)), "recommend",
                                      STRATIFIED_TARGETS, seed="0")


@register("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    m, tf = chain.trained_model(_src(spark, sf_dir))
    return model.confusion(m, tf.where(F.col("is_test")))


@register("prediction_histogram")
def q_prediction_histogram(spark, sf_dir):
    return quality.value_counts(chain.model_predictions(_src(spark, sf_dir)), "recommend")


@register("feed_from_model")
def q_feed_from_model(spark, sf_dir):
    return feed.generate_feed(chain.model_predictions(_src(spark, sf_dir)), chain.FEED_NOW, FeedParams())


# ------------------------------------------------------- streaming and sinks
def _yearly_runs(posts: DataFrame) -> DataFrame:
    return posts.withColumn("dtime", (F.year("block_timestamp").cast("bigint") * F.lit(10 ** 10)
                                      + F.lit(101000000)).cast("bigint"))


@register("stream_increment")
def q_stream_increment(spark, sf_dir):
    """Posts arrive as yearly runs in two increments; each increment is
    turned into post features exactly once by the file stream."""
    src = _src(spark, sf_dir)
    root, out, ckpt = (scratch_path(spark, n) for n in ("stream-src", "stream-out", "stream-ckpt"))
    runs = _yearly_runs(src.profile_post())
    runs.where(F.col("dtime") < 19960101000000).write.mode("append").partitionBy("dtime").parquet(root)
    schema = spark.read.parquet(root).schema
    # written once: every micro-batch joins it
    stats = materialize(src.publication_stats(), "stats")

    def transform(batch):
        return posts_with_stats(post_flags(batch, chain.FIXTURE_FEATURE_TIME), stats)

    stream_inc.run_increment(spark, root, schema, ckpt, out, transform)
    runs.where(F.col("dtime") >= 19960101000000).write.mode("append").partitionBy("dtime").parquet(root)
    stream_inc.run_increment(spark, root, schema, ckpt, out, transform)
    return stream_inc.read_output(spark, out)


@register("stream_dedupe")
def q_stream_dedupe(spark, sf_dir):
    """Prediction runs stream in; an older run arriving late does not
    replace newer rows already stored (L2)."""
    hist = _history(spark, sf_dir).select("post_id", "dtime", "recommend")
    root, out, ckpt = (scratch_path(spark, n) for n in ("dedupe-src", "dedupe-out", "dedupe-ckpt"))
    hist.where(F.col("dtime") != chain.PREVIOUS_RUN).write.mode("append").partitionBy("dtime").parquet(root)
    schema = spark.read.parquet(root).schema
    for _ in range(2):
        stream_inc.run_increment(spark, root, schema, ckpt, out, lambda b: b, dedupe_key="post_id")
        hist.where(F.col("dtime") == chain.PREVIOUS_RUN).write.mode("append").partitionBy("dtime").parquet(root)
    return latest_per_post(stream_inc.read_output(spark, out)).select("post_id", "dtime", "recommend")


# Runs in the order of their arrival; the last one is late.
ARRIVALS = (20231101000000, 20240115000000, 20240129000000, 20240131120000, 20230601000000)


@register("stream_watermark")
def q_stream_watermark(spark, sf_dir):
    """Predictions arrive run by run; a tenth of the earlier ones comes again with the fourth run, and the last run is late.
    Within ten days a post counts once."""
    hist = _history(spark, sf_dir).select("post_id", "dtime")
    again = hist.where(F.col("dtime").isin(*ARRIVALS[:3])).where(uniform_u32("post_id", "again") % 10 == 0)
    events = hist.unionByName(again.withColumn("dtime", F.lit(ARRIVALS[3]).cast("bigint")))
    events = materialize(events.withColumn("at", dtime_to_timestamp("dtime")), "arrivals")
    root, out, ckpt = (scratch_path(spark, n) for n in ("watermark-src", "watermark-out", "watermark-ckpt"))
    for run in ARRIVALS:
        events.where(F.col("dtime") == run).write.mode("append").parquet(root)
        stream_inc.run_watermarked(spark, root, events.schema, ckpt, out, "post_id", "at", "10 days")
    return spark.read.schema(events.schema).parquet(out).select("post_id", "dtime")


@register("feed_publish")
def q_feed_publish(spark, sf_dir):
    """Publish two strategies, then republish one: the other stays untouched."""
    hist = _history(spark, sf_dir)
    table = scratch_path(spark, "feed")
    proto = feed.generate_feed(hist, chain.FEED_NOW, FeedParams.prototype(), order="recent") \
        .withColumn("strategy_name", F.lit("ml-recent"))
    p = FeedParams()
    main = feed.generate_feed(hist, chain.FEED_NOW, p)
    publish.publish_feed(proto, table, "ml-recent")
    publish.publish_feed(main, table, p.strategy_name)
    publish.publish_feed(main, table, p.strategy_name)
    return publish.read_feed(spark, table)


@register("feed_versions")
def q_feed_versions(spark, sf_dir):
    """The pointer table after a feed, a shorter one and an empty one were published under one name."""
    p = FeedParams()
    table = scratch_path(spark, "feed")
    main = materialize(feed.generate_feed(_history(spark, sf_dir), chain.FEED_NOW, p), "feed")
    for rows in (main, main.where("v < 100"), main.where("v < 0")):
        publish.publish_feed(rows, table, p.strategy_name)
    return publish.feed_versions(spark, table).select("strategy_name", "version", "rows")


@register("feed_publish_empty")
def q_feed_publish_empty(spark, sf_dir):
    """Publish two strategies, then republish one with an empty feed: only the other is left."""
    p = FeedParams()
    table = scratch_path(spark, "feed")
    main = feed.generate_feed(_history(spark, sf_dir), chain.FEED_NOW, p)
    publish.publish_feed(main, table, p.strategy_name)
    other = main.withColumn("strategy_name", F.lit("ml-other"))
    publish.publish_feed(other, table, "ml-other")
    publish.publish_feed(other.where("v < 0"), table, "ml-other")
    return publish.read_feed(spark, table)


@register("prediction_sink")
def q_prediction_sink(spark, sf_dir):
    """One run's labels written to dtime=<run>/recommend=<label>, written again with
    other labels, and read back: only the second writing is there."""
    preds = chain.labelled_posts(_src(spark, sf_dir), columns=()) \
        .select("post_id", "followship_rank", "recommend").where(F.col("recommend").isNotNull())
    preds = materialize(preds, "run")
    root = scratch_path(spark, "predictions")
    increments.save_predictions(preds.withColumn("recommend", F.lit("FIRST")), root, 20240201000000)
    increments.save_predictions(preds, root, 20240201000000)
    return increments.read_increment(spark, root, 20240101000000)


# ------------------------------------------- labels back on posts, typing, previews
@register("posts_with_labels")
def q_posts_with_labels(spark, sf_dir):
    """Every post with its label columns (left join on the post id)."""
    src = _src(spark, sf_dir)
    rec = chain.labelled_posts(src, columns=("followship_score",)).select(
        F.col("post_id").alias("recommend_post_id"), "recommend", "followship_rank",
        "followship_score", "post_score")
    posts = src.profile_post().select("post_id", "profile_id", "language", "main_content_focus",
                                      "custom_filters_gardener_flagged")
    return posts.join(rec, posts.post_id == rec.recommend_post_id, "left")


@register("typed_post_features")
def q_typed_post_features(spark, sf_dir):
    """Post features cast to the feature value types (missing ones NULL)."""
    feats = chain.post_features(_src(spark, sf_dir)).select("post_id", *schemas.POST_FEATURES.fieldNames()[:-2],
                                                             "profile_id")
    return schemas.enforce(feats, schemas.POST_FEATURES)


@register("format_timestamp")
def q_format_timestamp(spark, sf_dir):
    """The post timestamp as text for the feature ingest."""
    flags = post_flags(_src(spark, sf_dir).profile_post(), chain.FIXTURE_FEATURE_TIME)
    return format_timestamp(flags.select("post_id", "block_timestamp"))


@register("table_preview")
def q_table_preview(spark, sf_dir):
    """First rows of the profile table in id order (a limit without
    an order would be arbitrary)."""
    return views.view_profiles(_src(spark, sf_dir).profile()).orderBy("profile_id").limit(10)
