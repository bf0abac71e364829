"""Per-author maxima, post score, top posts, heuristic labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustfeed.operators.topk import top_k
from trustfeed.params import LabelParams, SCORE_WEIGHTS, SCORE_ZERO_DIVISOR
from trustfeed.session import materialize

MAX_COLUMNS = {"age": "max_age", "mirrors": "max_mirrors", "collects": "max_collects",
               "comments": "max_comments"}


def author_maxima(df: DataFrame, rank_col: str = "followship_rank",
                  zero_to_null: bool = True) -> DataFrame:
    """Add max_age/max_mirrors/max_collects/max_comments over the author's posts.

    The author is identified by its rank (one rank per profile); a NULL rank
    forms no group and gets NULL maxima. The maxima are aggregated first
    (map-side partial max, one row per author), written once, and joined
    back. Written, the per-author table is broadcast when small; when it is
    not, both join sides get their own shuffle, which is the shape AQE needs to
    split the partition of a hot author (an aggregate directly under the join
    reuses its shuffle and hides the skew from AQE). With ``zero_to_null`` a
    zero maximum becomes NULL (the score is the same either way).
    """
    aggs = []
    for src, dst in MAX_COLUMNS.items():
        m = F.max(src)
        if zero_to_null:
            m = F.nullif(m, F.lit(0).cast("bigint"))
        aggs.append(m.alias(dst))
    maxima = materialize(df.where(F.col(rank_col).isNotNull()).groupBy(rank_col).agg(*aggs), "author-maxima")
    return df.join(maxima, on=rank_col, how="left")


def _ratio(name: str, weight) -> F.Column:
    """|weight| * value / (max if max > 0 else 1e10)."""
    mx = F.col(MAX_COLUMNS[name])
    w = int(abs(weight)) if float(weight).is_integer() else abs(weight)
    return (F.lit(w) * F.col(name)) / F.when(mx > 0, mx).otherwise(F.lit(SCORE_ZERO_DIVISOR))


def post_score_expr(weights: dict | None = None) -> F.Column:
    """w1*mirrors/max + w2*collects/max + w3*comments/max + w4*age/max.

    Each maximum is replaced by 1e10 unless it is > 0 (NULL included). A NULL
    counter gives a NULL score. Summed left to right like the original, a
    negative weight subtracts its term.
    """
    w = dict(SCORE_WEIGHTS if weights is None else weights)
    names = ["mirrors", "collects", "comments", "age"]
    expr = _ratio(names[0], w[names[0]])
    if w[names[0]] < 0:
        expr = -expr
    for name in names[1:]:
        term = _ratio(name, w[name])
        expr = expr + term if w[name] >= 0 else expr - term
    return expr


def with_post_score(df: DataFrame, weights: dict | None = None, name: str = "post_score") -> DataFrame:
    return df.withColumn(name, post_score_expr(weights))


def top_posts(scored: DataFrame, rank_bound: int, k: int, rank_col: str = "followship_rank",
              score_col: str = "post_score", key: str = "post_id") -> DataFrame:
    """F2: the best ``k`` posts by score among authors ranked <= ``rank_bound``.

    Score descending with NULLs last, then post id. A threshold found beforehand
    (topk.py) keeps the rows that reach the final sort near k.
    """
    return top_k(scored.where(F.col(rank_col) <= rank_bound), score_col, key, k)


def heuristic_labels(scored: DataFrame, params: LabelParams = LabelParams(),
                     rank_col: str = "followship_rank", key: str = "post_id",
                     out: str = "recommend") -> DataFrame:
    """H2: YES for the top posts, else MAYBE for rank <= yes_rank, else NO for
    rank >= no_rank, else NULL (later rules take precedence, as assigned)."""
    top = top_posts(scored, params.yes_rank, params.top_k, rank_col, key=key) \
        .select(F.col(key).alias("_tf_top_id"), F.lit(True).alias("_tf_top"))
    j = scored.join(top, scored[key] == top["_tf_top_id"], "left").drop("_tf_top_id")
    label = (F.when(F.col("_tf_top"), F.lit("YES"))
             .when(F.col(rank_col) <= params.yes_rank, F.lit("MAYBE"))
             .when(F.col(rank_col) >= params.no_rank, F.lit("NO")))
    return j.withColumn(out, label).drop("_tf_top")
