"""Graph-edge views over the source tables (K1-K7) and the collect samples
(C8, C9, B13, B14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustfeed.functions.columns import id_head, id_tail, pg_concat
from trustfeed.params import CURRENCY_SCALE, MATIC_CONTRACT


def view_collects(records: DataFrame, profile: DataFrame) -> DataFrame:
    """K1: collector profile (by wallet) -> collected publication.

    Left join on wallet: a wallet owning several profiles fans out, a wallet
    owning none gives NULL profile columns.
    """
    p = profile.select("profile_id", "owned_by")
    j = records.join(p, records.collected_by == p.owned_by, "left")
    return j.select(
        pg_concat("profile_id", F.lit("-"), "collect_publication_nft_id").alias("collect_nft_id"),
        "profile_id",
        F.col("collect_publication_nft_id").alias("pub_id"),
        id_head("publication_id").alias("to_profile_id"),
        id_tail("publication_id").alias("to_pub_id"),
        F.col("record_id").alias("metadata"),
        F.col("block_timestamp").alias("created_at"),
    )


def view_comments(post_comment: DataFrame) -> DataFrame:
    """K2: commenter -> commented post's author and publication."""
    return post_comment.select(
        "comment_id",
        F.col("comment_by_profile_id").alias("profile_id"),
        F.col("contract_publication_id").alias("pub_id"),
        id_head("post_id").alias("to_profile_id"),
        id_tail("post_id").alias("to_pub_id"),
        "content_uri",
        F.col("block_timestamp").alias("created_at"),
    )


def view_follows(follower: DataFrame, profile: DataFrame) -> DataFrame:
    """K3: the follower wallet's profile -> followed profile (left join on wallet)."""
    p = profile.select("profile_id", "owned_by")
    j = follower.join(p, follower.address == p.owned_by, "left")
    return j.select("profile_id", F.col("follow_profile_id").alias("to_profile_id"),
                    F.col("block_timestamp").alias("created_at"))


def view_mirrors(profile_post: DataFrame) -> DataFrame:
    """K4: posts related to another post or comment, with the parsed target."""
    related = F.coalesce("is_related_to_post", "is_related_to_comment")
    r = profile_post.where(F.col("is_related_to_post").isNotNull() | F.col("is_related_to_comment").isNotNull()) \
        .select("post_id", "profile_id", F.col("contract_publication_id").alias("pub_id"),
                related.alias("is_related_to"), "block_timestamp")
    return r.select("post_id", "profile_id", "pub_id",
                    id_head("is_related_to").alias("to_profile_id"),
                    id_tail("is_related_to").alias("to_pub_id"),
                    F.col("block_timestamp").alias("created_at"))


def view_posts(profile_post: DataFrame) -> DataFrame:
    """K5."""
    return profile_post.select("post_id", "profile_id", F.col("contract_publication_id").alias("pub_id"),
                               "content_uri", F.col("block_timestamp").alias("created_at"))


def view_profiles(profile: DataFrame) -> DataFrame:
    """K6."""
    return profile.select("profile_id", F.col("owned_by").alias("owner_address"), "handle",
                          F.col("profile_picture_s3_url").alias("image_uri"),
                          F.col("metadata_block_timestamp").alias("created_at"))


def view_follow_counts(follower: DataFrame, profile: DataFrame) -> DataFrame:
    """Follows per follower profile; the NULL profile (unmatched wallets) is a group.

    Follows are counted per wallet before the join and summed per profile after it.
    """
    per_wallet = follower.groupBy("address").agg(F.count(F.lit(1)).alias("n"))
    p = profile.select("profile_id", "owned_by")
    return per_wallet.join(p, F.col("address") == F.col("owned_by"), "left") \
        .groupBy("profile_id").agg(F.sum("n").alias("count"))


def collected_posts(stats: DataFrame, profile_post: DataFrame, limit: int | None = None) -> DataFrame:
    """Stats joined to their post, collects > 0 (optional ordered preview)."""
    s = stats.where(F.col("total_amount_of_collects") > 0)
    out = s.join(profile_post, profile_post.post_id == s.publication_id, "inner")
    if limit is not None:
        out = out.orderBy("publication_id").limit(limit)
    return out


def collect_currency(details: DataFrame, profile_post: DataFrame, limit: int | None = None) -> DataFrame:
    """Collect modules of existing posts with a currency label.

    ``amt`` is the amount scaled by 1e18 (the original divided the address).
    """
    d = details.where(F.col("amount").isNotNull())
    posts = profile_post.select(F.col("post_id"))
    j = d.join(posts, posts.post_id == d.publication_id, "inner")
    out = j.select(
        (F.col("amount") / F.lit(CURRENCY_SCALE)).alias("amt"),
        F.when(F.col("currency") == F.lit(MATIC_CONTRACT), F.lit("MATIC")).otherwise(F.lit("OTHER"))
        .alias("currency_symbol"),
        "publication_id", "amount", "currency",
    )
    if limit is not None:
        out = out.orderBy("publication_id", "amount").limit(limit)
    return out
