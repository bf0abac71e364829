"""Feed generation: eligibility, engagement, recency, popularity, weights,
sampling, ordinal and publish (B4, B5, B6, B10, D7, H3, I1, I2, E2, F4, A10).

Only the capped sample (at most sum(caps) rows) and the final feed (at most
``feed_size`` rows) are small; everything before them is distributed.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from trustfeed.functions.columns import dtime_to_timestamp
from trustfeed.operators.dedupe import latest_per_post
from trustfeed.operators.sampling import capped_sample, weighted_sample
from trustfeed.params import (ENGAGEMENT_WEIGHTS, FEED_WEIGHTS_V1, FEED_WEIGHTS_V2, FILL_RANK,
                              POPULARITY_LABELS, FeedParams)
from trustfeed.session import materialize

FEED_COLUMNS = ["post_id", "recommend", "dtime", "engagement_score"]


def engagement_expr(weights: dict | None = None) -> F.Column:
    """w_up*upvotes + w_mirror*mirrors + w_comment*comments + w_collect*collects."""
    w = dict(ENGAGEMENT_WEIGHTS if weights is None else weights)
    expr = None
    for name in ("upvotes", "mirrors", "comments", "collects"):
        if not w.get(name):
            continue
        term = F.lit(int(w[name])) * F.col(name)
        expr = term if expr is None else expr + term
    return expr


def feed_flags(preds: DataFrame, weights: dict | None = None) -> DataFrame:
    """The feed columns plus ``eligible`` (B4): what de-duplication has to carry, and no more."""
    ok = F.col("is_original") & ~F.col("is_content_warning") & (F.col("recommend") != "NO")
    return preds.select("post_id", "recommend", "dtime", engagement_expr(weights).alias("engagement_score"),
                        ok.alias("eligible"))


def feed_eligible(preds: DataFrame, weights: dict | None = None,
                  require_engagement: bool = True) -> DataFrame:
    """B4 + B5: original, not content-warned, label not NO; engagement > 0.

    NULL flags or labels fail the test (three-valued logic), as in the
    original string comparisons.
    """
    return eligible_rows(feed_flags(preds, weights), require_engagement)


def eligible_rows(flags: DataFrame, require_engagement: bool = True) -> DataFrame:
    df = flags.where("eligible")
    if require_engagement:
        df = df.where(F.col("engagement_score") > 0)
    return df.select(*FEED_COLUMNS)


def current_eligible(preds: DataFrame, weights: dict | None = None, require_engagement: bool = True) -> DataFrame:
    """G3 + B4 + B5: the newest prediction of each post, if it is eligible."""
    return eligible_rows(latest_per_post(feed_flags(preds, weights)), require_engagement)


def recency_bucket(df: DataFrame, now, buckets, mode: str = "elapsed",
                   out: str = "time_ago") -> DataFrame:
    """Bucket name by the age of the run (``dtime``) at ``now``.

    ``elapsed``: real seconds between the run time and ``now``.
    ``packed``: the original arithmetic on packed YYYYMMDDHHMMSS integers
    (a day is 1,000,000 there, so the bounds mean something else, see README).
    """
    if mode == "elapsed":
        age = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp(dtime_to_timestamp("dtime"))
    elif mode == "packed":
        now_packed = int(str(now).replace("-", "").replace(":", "").replace(" ", "").replace("T", "")[:14])
        age = F.lit(now_packed) - F.col("dtime")
    else:
        raise ValueError(mode)
    expr = None
    for name, bound in buckets:
        if bound is None:
            expr = expr.otherwise(F.lit(name)) if expr is not None else F.lit(name)
            break
        cond = age < F.lit(bound)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn(out, expr)


def popularity_bins(df: DataFrame, col: str = "engagement_score", out: str = "popularity",
                    labels=POPULARITY_LABELS) -> DataFrame:
    """Terciles C/B/A of ``col``: cut points at quantiles 1/3 and 2/3
    (linear interpolation), right-closed bins, lowest value in C.

    The cut points are exact on input of any size: values are counted per
    distinct value, the counts are numbered in a distributed order, and the
    values at the four ranks around the quantiles are picked. Equal cut points
    collapse a bin instead of failing.
    """
    q1, q2 = exact_quantiles(df, col, ((1, 3), (2, 3)))
    low, mid, high = labels
    x = F.col(col)
    label = F.when(x <= F.lit(q1), F.lit(low)).when(x <= F.lit(q2), F.lit(mid)).when(x.isNotNull(), F.lit(high))
    return df.withColumn(out, label)


def exact_quantiles(df: DataFrame, col: str, fractions) -> list:
    """The (a, b) = a/b quantiles of ``col`` with linear interpolation (None for no rows).

    Rows are counted per value (combined before the shuffle), the values are
    range-partitioned and sorted, and a running count over them is made from one
    total per partition, so no task sees more than its share of the values. Two
    numbers per quantile reach the driver.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("x")).agg(F.count(F.lit(1)).alias("n"))
    ordered = materialize(counts.orderBy("x").withColumn("p", F.spark_partition_id()), "quantile-values")
    totals = ordered.groupBy("p").agg(F.sum("n").alias("t"))
    n = totals.agg(F.sum("t")).first()[0]
    if not n:
        return [None] * len(fractions)
    before = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("p", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("p").orderBy("x")
    upto = ordered.join(F.broadcast(starts), "p").select("x", (F.col("start") + F.sum("n").over(inside)).alias("upto"))
    places = [(n - 1) * (a / b) for a, b in fractions]
    ranks = sorted({k for x in places for k in (math.floor(x), math.ceil(x))})
    at = upto.agg(*[F.min(F.when(F.col("upto") > k, F.col("x"))).alias(f"r{k}") for k in ranks]).first()
    out = []
    for x in places:
        lo, hi = float(at[f"r{math.floor(x)}"]), float(at[f"r{math.ceil(x)}"])
        out.append(lo + (hi - lo) * (x - math.floor(x)))
    return out


def popularity_cut_points(df: DataFrame, col: str = "engagement_score") -> DataFrame:
    """The tercile cut points q0..q3 as one row (the ``retbins`` of the binning)."""
    q1, q2 = (F.lit(q).cast("double") for q in exact_quantiles(df, col, ((1, 3), (2, 3))))
    return df.agg(F.min(col).cast("double").alias("q0"), F.max(col).cast("double").alias("q3")) \
        .select("q0", q1.alias("q1"), q2.alias("q2"), "q3")


def feed_weights(df: DataFrame, profile: str = "v2", out: str = "weights") -> DataFrame:
    """H3: sampling weight from popularity and label.

    v2: A&YES .75, A&other .1, everything else .15.
    v1: YES&A .4, YES&B .3, YES&C .1, everything else .2.
    """
    pop, rec = F.col("popularity"), F.col("recommend")
    if profile == "v2":
        w = FEED_WEIGHTS_V2
        expr = F.when(pop == "A", F.when(rec == "YES", F.lit(w["A_YES"])).otherwise(F.lit(w["A_OTHER"]))) \
            .otherwise(F.lit(w["OTHER"]))
    elif profile == "v1":
        w = FEED_WEIGHTS_V1
        expr = F.when(rec == "YES", F.when(pop == "A", F.lit(w["YES_A"]))
                      .when(pop == "B", F.lit(w["YES_B"])).otherwise(F.lit(w["YES_C"]))) \
            .otherwise(F.lit(w["OTHER"]))
    else:
        raise ValueError(profile)
    return df.withColumn(out, expr)


def feed_order(order: str = "weights") -> list:
    """final order; ``weights`` = weights desc, engagement desc (pipeline),
    ``recent`` = dtime desc, weights desc (prototype); post id breaks ties."""
    if order == "weights":
        return [F.col("weights").desc(), F.col("engagement_score").desc(), F.col("post_id").asc()]
    if order == "recent":
        return [F.col("dtime").desc(), F.col("weights").desc(), F.col("post_id").asc()]
    raise ValueError(order)


def feed_ordinal(sampled: DataFrame, strategy_name: str, order: str = "weights") -> DataFrame:
    """(strategy_name, post_id, v) with v the 0-based position in the order.

    The input is the weighted sample (at most ``feed_size`` rows), so the
    single ordered window works on a bounded set.
    """
    w = Window.orderBy(*feed_order(order))
    return sampled.select(
        F.lit(strategy_name).alias("strategy_name"), "post_id",
        (F.row_number().over(w) - 1).cast("double").alias("v"))


def sampled_candidates(preds: DataFrame, now, params: FeedParams = FeedParams()) -> DataFrame:
    """Eligible posts, bucketed by recency and capped per bucket."""
    if params.latest_per_post:
        elig = current_eligible(preds, params.engagement_weights, params.require_engagement)
    else:
        elig = feed_eligible(preds, params.engagement_weights, params.require_engagement)
    bucketed = recency_bucket(elig, now, params.buckets, params.recency_mode)
    return capped_sample(bucketed, "time_ago", params.caps, seed=params.seed)


def weighted_candidates(preds: DataFrame, now, params: FeedParams = FeedParams()) -> DataFrame:
    """Capped sample with popularity and weight.

    The tercile cut points and the rows both read the sample, which is written
    once (at most sum(caps) rows).
    """
    sample = materialize(sampled_candidates(preds, now, params), "feed-sample")
    return feed_weights(popularity_bins(sample), params.weight_profile)


def generate_feed(preds: DataFrame, now, params: FeedParams = FeedParams(),
                  order: str = "weights") -> DataFrame:
    """The whole feed: candidates -> popularity -> weights -> weighted sample -> ordinal."""
    weighted = weighted_candidates(preds, now, params)
    chosen = weighted_sample(weighted, "weights", params.feed_size, seed=params.seed + "-w")
    return feed_ordinal(chosen, params.strategy_name, order)


def fill_nulls(df: DataFrame, rank_col: str = "followship_rank", rank_fill=FILL_RANK,
               skip: tuple = ()) -> DataFrame:
    """Rank -> 1e10, other numerics -> 0, text -> ''. Booleans keep NULL."""
    fills = {}
    for f in df.schema.fields:
        if f.name in skip:
            continue
        if f.name == rank_col:
            fills[f.name] = rank_fill
        elif isinstance(f.dataType, NumericType):
            fills[f.name] = 0
        elif isinstance(f.dataType, StringType):
            fills[f.name] = ""
    cols = []
    for f in df.schema.fields:
        if f.name in fills:
            cols.append(F.coalesce(F.col(f.name), F.lit(fills[f.name]).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
