"""Trust snapshots and profile ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustfeed.operators.dedupe import dedupe_by_key
from trustfeed.operators.global_rank import global_row_number
from trustfeed.params import TRUST_STRATEGY


def latest_snapshot(globaltrust: DataFrame, strategy=TRUST_STRATEGY,
                    strategy_col: str = "strategy_name") -> DataFrame:
    """Rows of ``strategy`` whose date equals the newest date of that strategy.

    The newest date is an uncorrelated scalar subquery: planned once, its single
    value is inlined into the filter (no join, no broadcast of a table).
    """
    g = globaltrust.where(F.col(strategy_col) == F.lit(strategy))
    newest = g.select(F.max("date")).scalar()
    return g.where(F.col("date") == newest)


def trust_rank(globaltrust: DataFrame, profile: DataFrame, strategy=TRUST_STRATEGY,
               strategy_col: str = "strategy_name", profile_key: str = "profile_id",
               snapshot_date=None) -> DataFrame:
    """rank (1 = highest v), score, profile_handle, profile_id for the newest
    snapshot of ``strategy`` (or the snapshot of ``snapshot_date``).

    Ties in ``v`` are broken by profile id, so the rank is a permutation 1..n.
    """
    if snapshot_date is None:
        snap = latest_snapshot(globaltrust, strategy, strategy_col)
    else:
        snap = globaltrust.where((F.col(strategy_col) == F.lit(strategy))
                                 & (F.col("date") == F.lit(snapshot_date).cast("date")))
    snap = snap.select("i", "v")
    prof = profile.select(F.col(profile_key).alias("profile_id"), F.col("handle"))
    joined = snap.join(prof, snap.i == prof.profile_id, "inner").select(
        F.col("v").alias("score"), F.col("handle").alias("profile_handle"), "profile_id")
    ranked = global_row_number(joined, [F.col("score").desc(), F.col("profile_id").asc()], "rank")
    return ranked.select("rank", "score", "profile_handle", "profile_id")


def profile_trust_features(ranked: DataFrame, prefix: str = "followship") -> DataFrame:
    """Rename rank/score to the profile feature names (rank as feature, score)."""
    return ranked.select(
        "profile_id",
        F.col("rank").alias(f"{prefix}_rank"),
        F.col("score").alias(f"{prefix}_score"),
    )


def profile_trust_by_handle(profile: DataFrame, ranked: DataFrame) -> DataFrame:
    """Profiles left-joined to trust by handle, after one row per handle.

    The survivor of a duplicated handle is the smallest rank (best), then the
    smallest profile id.
    """
    by_handle = dedupe_by_key(
        ranked.select("profile_handle", "rank", "score", F.col("profile_id").alias("trust_profile_id")),
        ["profile_handle"], ["rank", "trust_profile_id"])
    return profile.join(by_handle, profile.handle == by_handle.profile_handle, "left") \
        .drop("profile_handle")


def post_author_trust(posts: DataFrame, ranked: DataFrame, author_col: str = "profile_id") -> DataFrame:
    """C4: posts left-joined to the trust rank/score of their author."""
    t = ranked.select(F.col("profile_id").alias("_author"), "rank", "score")
    return posts.join(t, posts[author_col] == t._author, "left").drop("_author")
