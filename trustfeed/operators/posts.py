"""Post features (B2, B3, B9, B11, C1, and the feature rename of A11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustfeed.functions.columns import try_bool
from trustfeed.schemas import POST_SOURCE_COLUMNS, STATS_TO_FEATURES


def post_flags(posts: DataFrame, feature_time) -> DataFrame:
    """Typed post columns plus is_original, is_content_warning and age in days.

    is_original: neither related column set. is_content_warning: a warning is
    present. Text booleans use try_cast, so bad text becomes NULL. age counts
    calendar days between the post and ``feature_time`` (UTC session).
    """
    p = posts.select(*POST_SOURCE_COLUMNS)
    ts = F.col("block_timestamp").cast("timestamp")
    return p.select(
        "post_id", "profile_id",
        try_bool("is_hidden").alias("is_hidden"),
        try_bool("is_gated").alias("is_gated"),
        ts.alias("block_timestamp"),
        "language", "region", "content_warning", "main_content_focus", "tags_vector",
        try_bool("custom_filters_gardener_flagged").alias("custom_filters_gardener_flagged"),
        (F.col("is_related_to_post").isNull() & F.col("is_related_to_comment").isNull()).alias("is_original"),
        F.col("content_warning").isNotNull().alias("is_content_warning"),
        F.datediff(F.lit(feature_time).cast("timestamp"), ts).cast("bigint").alias("age"),
    )


def posts_with_stats(flags: DataFrame, stats: DataFrame) -> DataFrame:
    """Posts left outer publication stats on post_id = publication_id.

    Posts without stats keep NULL counters.
    """
    s = stats.drop("datastream_metadata")
    return flags.join(s, flags.post_id == s.publication_id, "left")


def post_feature_frame(with_stats: DataFrame) -> DataFrame:
    """Feature-named post frame: counters renamed, publication id dropped."""
    return with_stats.select(*[F.col(c).alias(STATS_TO_FEATURES.get(c, c))
                               for c in with_stats.columns if c != "publication_id"])


def format_timestamp(df: DataFrame, col: str = "block_timestamp",
                     fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Timestamp to text."""
    return df.withColumn(col, F.date_format(F.col(col), fmt))
