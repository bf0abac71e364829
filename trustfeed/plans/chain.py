"""Stage compositions: source tables -> features -> trust -> score -> labels.

Each function returns a lazy DataFrame; nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustfeed.operators.posts import STATS_TO_FEATURES, post_feature_frame, post_flags, posts_with_stats
from trustfeed.operators.scoring import author_maxima, heuristic_labels, with_post_score
from trustfeed.operators.trust import profile_trust_features, trust_rank
from trustfeed.params import LabelParams, TRUST_STRATEGY
from trustfeed.session import materialize
from trustfeed.sources.driver_tables import SourceTables

# Parameters that fit the driver tables (1,500 profiles at sf0.01): the label
# thresholds of the original (1000 / 50000 / 1000) would label nothing.
FIXTURE_FEATURE_TIME = "2002-01-01 00:00:00"
FIXTURE_LABELS = LabelParams(yes_rank=100, no_rank=1000, top_k=100)


def post_features(src: SourceTables, feature_time=FIXTURE_FEATURE_TIME, columns=None) -> DataFrame:
    """Feature-named post frame (posts + stats) at ``feature_time``.

    With ``columns`` only these are made; the counters are joined only if one of
    them is asked for.
    """
    flags = post_flags(src.profile_post(), feature_time)
    if columns is not None and not set(columns) & set(STATS_TO_FEATURES.values()):
        return flags.select(*[c for c in flags.columns if c in columns])
    feats = post_feature_frame(posts_with_stats(flags, src.publication_stats()))
    return feats if columns is None else feats.select(*[c for c in feats.columns if c in columns])


def ranked_profiles(src: SourceTables, strategy=TRUST_STRATEGY) -> DataFrame:
    return trust_rank(src.globaltrust(), src.profile(), strategy)


def posts_with_trust(src: SourceTables, feature_time=FIXTURE_FEATURE_TIME,
                     strategy=TRUST_STRATEGY, columns=None) -> DataFrame:
    """Post features plus the author's followship rank and score (left join).

    ``columns``: those to make (default all); the caller names them, so that a
    written copy holds no others.
    """
    trust = profile_trust_features(ranked_profiles(src, strategy))
    wanted = None if columns is None else {*columns, "profile_id"}
    joined = post_features(src, feature_time, wanted).join(trust, "profile_id", "left")
    return joined if columns is None else joined.select(*[c for c in joined.columns if c in columns])


# What the score is made of.
SCORE_INPUTS = ("post_id", "profile_id", "followship_rank", "age", "mirrors", "collects", "comments")


def scored_posts(src: SourceTables, feature_time=FIXTURE_FEATURE_TIME,
                 strategy=TRUST_STRATEGY, zero_to_null: bool = True, columns=None) -> DataFrame:
    """Posts with author maxima and post score.

    The features are written once because the maxima and the rows both read
    them: the score's inputs and ``columns`` (default: all).
    """
    wanted = None if columns is None else {*SCORE_INPUTS, *columns}
    feats = materialize(posts_with_trust(src, feature_time, strategy, wanted), "features")
    return with_post_score(author_maxima(feats, zero_to_null=zero_to_null))


def labelled_posts(src: SourceTables, feature_time=FIXTURE_FEATURE_TIME,
                   params: LabelParams = FIXTURE_LABELS, strategy=TRUST_STRATEGY, columns=None) -> DataFrame:
    return heuristic_labels(scored_posts(src, feature_time, strategy, columns=columns), params)


def score_columns() -> list[str]:
    return ["post_id", "profile_id", "followship_rank", "followship_score", "age", "mirrors",
            "collects", "comments", "max_age", "max_mirrors", "max_collects", "max_comments",
            "post_score"]




# ------------------------------------------------------------------ predictions
# Fixture runs: each post is predicted in one run chosen by month(post) % 4,
# so the four recency buckets are all populated at FEED_NOW; posts whose hash
# key is divisible by 7 were also predicted in an older run (PREVIOUS_RUN).
FEED_NOW = "2024-02-01 00:00:00"
RUN_DTIMES = (20240131120000, 20240129000000, 20240115000000, 20231101000000)
PREVIOUS_RUN = 20230601000000
PREDICTION_COLUMNS = [
    "post_id", "profile_id", "is_original", "is_content_warning", "custom_filters_gardener_flagged",
    "language", "region", "content_warning", "main_content_focus", "age", "upvotes", "downvotes",
    "mirrors", "comments", "collects", "followship_rank", "followship_score", "post_score", "recommend",
]


# What the feed is made of.
FEED_INPUTS = ("post_id", "is_original", "is_content_warning", "upvotes", "mirrors", "comments", "collects", "recommend")


def current_predictions(src: SourceTables, columns=PREDICTION_COLUMNS) -> DataFrame:
    """Labelled posts as a prediction run: B10 null filling plus the run id.

    A missing label stays missing, so that it can't pass for one that isn't NO.
    """
    from trustfeed.operators.feed import fill_nulls

    lab = labelled_posts(src, columns=(*columns, "block_timestamp")).select(*columns, "block_timestamp")
    run = F.element_at(F.array(*[F.lit(d) for d in RUN_DTIMES]),
                       (F.month("block_timestamp") % 4 + 1).cast("int"))
    return fill_nulls(lab.withColumn("dtime", run.cast("bigint")).drop("block_timestamp"), skip=("recommend",))


def prediction_history(src: SourceTables, columns=FEED_INPUTS) -> DataFrame:
    """Current run plus an older run holding a repeatable seventh of the posts."""
    from trustfeed.functions.columns import uniform_u32

    cur = materialize(current_predictions(src, columns), "predictions")
    prev = cur.where(uniform_u32("post_id", "prev") % 7 == 0) \
        .withColumn("dtime", F.lit(PREVIOUS_RUN).cast("bigint"))
    return cur.unionByName(prev)


# ------------------------------------------------------------------ feature store
# Two ingests per entity type: posts at an older and the fixture feature time,
# profiles once per followship snapshot (feature time = snapshot date).
POST_INGEST_TIMES = ("2001-06-01 00:00:00", FIXTURE_FEATURE_TIME)
PROFILE_SNAPSHOTS = ("2024-01-01", "2024-01-08")
LOOKUP_START = "2001-01-01 00:00:00"
LOOKUP_TIME = "2024-01-05 00:00:00"
LOOKUP_TIME_LATE = "2024-01-10 00:00:00"


def post_feature_ingest(src: SourceTables, feature_time=FIXTURE_FEATURE_TIME) -> DataFrame:
    from trustfeed.operators.features import POST_FEATURES, ingest_features
    return ingest_features(post_features(src, feature_time), "post_id", feature_time, POST_FEATURES)


def profile_feature_ingest(src: SourceTables, snapshot_date=None, feature_time=None) -> DataFrame:
    from trustfeed.operators.features import PROFILE_FEATURES, ingest_features
    ranked = trust_rank(src.globaltrust(), src.profile(), TRUST_STRATEGY, snapshot_date=snapshot_date)
    ft = feature_time or f"{snapshot_date} 00:00:00"
    return ingest_features(ranked, "profile_id", ft, PROFILE_FEATURES,
                           {"followship_rank": "rank", "followship_score": "score"})


def post_feature_history(src: SourceTables) -> DataFrame:
    """Both post ingests from one materialized feature frame: only ``age``
    depends on the feature time, so it is recomputed per ingest."""
    from trustfeed.operators.features import POST_FEATURES, ingest_features
    base = materialize(post_features(src, POST_INGEST_TIMES[-1]), "post-features")
    parts = []
    for t in POST_INGEST_TIMES:
        at = base.withColumn("age", F.datediff(F.lit(t).cast("timestamp"), F.col("block_timestamp"))
                             .cast("bigint"))
        parts.append(ingest_features(at, "post_id", t, POST_FEATURES))
    return parts[0].unionByName(parts[1])


def profile_feature_history(src: SourceTables) -> DataFrame:
    a, b = (profile_feature_ingest(src, d) for d in PROFILE_SNAPSHOTS)
    return a.unionByName(b)


def lookup_instances(src: SourceTables, per_row_time: bool = False) -> DataFrame:
    """(entity_type_posts, entity_type_profiles, timestamp) for every post."""
    p = src.profile_post()
    ts = F.lit(LOOKUP_TIME).cast("timestamp")
    if per_row_time:
        ts = F.when(F.month("block_timestamp") % 2 == 0, ts) \
            .otherwise(F.lit(LOOKUP_TIME_LATE).cast("timestamp"))
    return p.select(F.col("post_id").alias("entity_type_posts"),
                    F.col("profile_id").alias("entity_type_profiles"), ts.alias("timestamp"))


# ------------------------------------------------------------------ model
def training_frame(src: SourceTables) -> DataFrame:
    """Labelled posts with a repeatable, label-stratified test flag (I4).

    The split writes the rows once: training, prediction and evaluation read that table.
    """
    from trustfeed.operators.model import BOOL_FEATURES, CATEGORICAL_FEATURES, NUMERIC_FEATURES
    from trustfeed.operators.sampling import train_test_split
    from trustfeed.params import SPLIT_SEED, TEST_FRACTION
    cols = [*PREDICTION_COLUMNS, *NUMERIC_FEATURES, *BOOL_FEATURES, *CATEGORICAL_FEATURES, "block_timestamp"]
    lab = labelled_posts(src, columns=cols).select(*dict.fromkeys(cols))
    return train_test_split(lab, TEST_FRACTION, seed=SPLIT_SEED)


def split_labels(src: SourceTables) -> DataFrame:
    """post_id, label and test flag only."""
    from trustfeed.operators.sampling import train_test_split
    from trustfeed.params import SPLIT_SEED, TEST_FRACTION
    lab = labelled_posts(src, columns=("post_id",)).select("post_id", "recommend")
    return train_test_split(lab, TEST_FRACTION, seed=SPLIT_SEED)


def trained_model(src: SourceTables, classifier: str = "rf", **kw):
    from trustfeed.operators.model import train
    tf = training_frame(src)
    return train(tf.where(~F.col("is_test")), classifier, **kw), tf


def model_predictions(src: SourceTables, classifier: str = "rf", **kw) -> DataFrame:
    """Every post with its predicted label (J5) as a prediction run."""
    from trustfeed.operators.feed import fill_nulls
    from trustfeed.operators.model import predict

    model, tf = trained_model(src, classifier, **kw)
    keep = [c for c in PREDICTION_COLUMNS if c != "recommend"] + ["block_timestamp"]
    pred = predict(model, tf.drop("recommend"), keep=keep)
    run = F.element_at(F.array(*[F.lit(d) for d in RUN_DTIMES]),
                       (F.month("block_timestamp") % 4 + 1).cast("int"))
    return fill_nulls(pred.withColumn("dtime", run.cast("bigint")).drop("block_timestamp"), skip=("recommend",))


def predicted_unlabelled(src: SourceTables, classifier: str = "rf", **kw) -> DataFrame:
    """J5 + C6 on the posts the rule left unlabelled: posts with their predicted label."""
    from trustfeed.operators.model import predict
    from trustfeed.operators.quality import unlabelled

    model, tf = trained_model(src, classifier, **kw)
    labels = predict(model, unlabelled(tf).drop("recommend")).select(
        F.col("post_id").alias("recommend_post_id"), "recommend")
    posts = src.profile_post().select("post_id", "profile_id", "language", "main_content_focus")
    return posts.join(materialize(labels, "predicted-labels"), F.col("post_id") == F.col("recommend_post_id")) \
        .drop("recommend_post_id")
