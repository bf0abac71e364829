"""Repeatable sampling.

Randomness comes from ``md5(key || seed)`` (see ``functions.columns``), so a
sample is the same on every run, on recomputation after a lost executor, and
in the DuckDB oracle.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trustfeed.functions.columns import uniform01, uniform_u32
from trustfeed.operators.global_rank import global_row_number
from trustfeed.session import materialize

# Candidates kept per bucket, as a multiple of its cap, before the exact cut.
OVERSAMPLE = 2.0
_U32 = 1 << 32
# Leading bits of a draw that name the cell it is counted in for a split.
SPLIT_CELL_BITS = 16


def _threshold(n: int, cap: int, factor: float) -> int:
    """Keep draws u < threshold: all rows if the bucket fits its cap, else
    about ``factor * cap`` of them (u is uniform on [0, 2^32))."""
    if n <= cap:
        return _U32
    return min(_U32, int(math.ceil(_U32 * factor * cap / n)))


def capped_sample(df: DataFrame, bucket_col: str, caps: dict, key: str = "post_id",
                  seed: str = "feed", oversample: float = OVERSAMPLE) -> DataFrame:
    """Uniform sample without replacement of at most ``caps[b]`` rows per bucket.

    The rows kept are the ``cap`` smallest ``md5(key || seed)`` draws of each
    bucket (ties by key), computed without moving whole buckets:

    1. the keyed rows are written once and counted per bucket (one number per
       bucket reaches the driver);
    2. a map-side filter keeps the draws below ``oversample * cap / n`` of the
       draw range - about ``oversample * cap`` candidates per bucket,
       whatever the data size - and the candidates are written once;
    3. a bucket with fewer than ``min(cap, n)`` candidates (rare: a
       binomial tail) is drawn again with a threshold four times as large, so
       the result is exact and candidates stay within a few times the cap;
    4. the cap smallest candidates per bucket are kept by a window over
       the candidates only.

    A window over the raw rows would instead send every map task's ``cap``
    rows per bucket to one task, which grows with the number of map tasks.
    Buckets without a cap are dropped.
    """
    caps = {b: int(c) for b, c in caps.items()}
    keyed = materialize(df.where(F.col(bucket_col).isin(list(caps))).withColumn("_tf_u", uniform_u32(key, seed)),
                        "sample-keyed")
    counts = {r[0]: r[1] for r in keyed.groupBy(bucket_col).count().collect()}
    factor = {b: oversample for b in caps}
    while True:
        tau = {b: _threshold(counts.get(b, 0), caps[b], factor[b]) for b in caps}
        tau_map = F.create_map(*[x for b, t in tau.items() for x in (F.lit(b), F.lit(t).cast("bigint"))])
        cand = materialize(keyed.where(F.col("_tf_u") < F.element_at(tau_map, F.col(bucket_col))),
                           "sample-candidates")
        got = {r[0]: r[1] for r in cand.groupBy(bucket_col).count().collect()}
        short = [b for b in caps if got.get(b, 0) < min(caps[b], counts.get(b, 0))]
        if not short:
            break
        for b in short:
            factor[b] *= 4
    max_cap = max(caps.values())
    cap_map = F.create_map(*[x for b, c in caps.items() for x in (F.lit(b), F.lit(c))])
    w = Window.partitionBy(bucket_col).orderBy(F.col("_tf_u").asc(), F.col(key).asc())
    ranked = cand.withColumn("_tf_rn", F.row_number().over(w)).where(F.col("_tf_rn") <= max_cap)
    return ranked.where(F.col("_tf_rn") <= F.element_at(cap_map, F.col(bucket_col))) \
        .drop("_tf_u", "_tf_rn")


def weighted_sample(df: DataFrame, weight_col: str, n: int, key: str = "post_id",
                    seed: str = "weights") -> DataFrame:
    """Weighted sample without replacement of min(n, rows) rows.

    Efraimidis-Spirakis: each row draws ``-ln(u) / w`` and the ``n`` smallest
    are kept (a distributed top-n: each task keeps n rows). Rows with
    non-positive or NULL weight are never drawn.
    """
    es = -F.log(uniform01(key, seed)) / F.col(weight_col)
    return df.where(F.col(weight_col) > 0).withColumn("_tf_es", es) \
        .orderBy(F.col("_tf_es").asc(), F.col(key).asc()).limit(n).drop("_tf_es")


def uniform_sample(df: DataFrame, n: int, key: str = "post_id", seed: str = "preview") -> DataFrame:
    """N rows uniformly without replacement (distributed top-n on the hash key)."""
    return df.withColumn("_tf_u", uniform_u32(key, seed)) \
        .orderBy(F.col("_tf_u").asc(), F.col(key).asc()).limit(n).drop("_tf_u")


def train_test_split(df: DataFrame, test_fraction: float = 0.25, key: str = "post_id",
                     seed: str = "1", label_col: str = "recommend", flag: str = "is_test") -> DataFrame:
    """I4: mark ``test_fraction`` of the rows of every label as test, exactly (half a row rounds up).

    In the order (draw, key) the first ``floor(fraction * rows + 1/2)`` rows of
    a label are test. NULL is a label of its own. The rows are written once with
    their draw and counted per label and cell of draws; a whole cell before or
    after the label's cut is all test or all training, so only the rows of the
    one cell per label that the cut falls into are put in order and numbered.
    """
    drawn = materialize(df.withColumn("_tf_u", uniform_u32(key, seed)), "split-rows")
    # a missing key has no draw and comes first
    cell = F.coalesce(F.shiftright("_tf_u", 32 - SPLIT_CELL_BITS), F.lit(-1))
    sizes = materialize(drawn.groupBy(F.col(label_col).alias("_tf_label"), cell.alias("_tf_cell"))
                        .agg(F.count(F.lit(1)).alias("_tf_n")), "split-cells")
    label = Window.partitionBy("_tf_label")
    upto = label.orderBy("_tf_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tests = F.floor(F.sum("_tf_n").over(label) * F.lit(float(test_fraction)) + 0.5)
    # of each label the cell of its last test row, and how many of that cell's rows are test
    cuts = sizes.withColumn("_tf_upto", F.sum("_tf_n").over(upto)).withColumn("_tf_tests", tests) \
        .where((F.col("_tf_upto") >= F.col("_tf_tests")) & (F.col("_tf_upto") - F.col("_tf_n") < F.greatest("_tf_tests", F.lit(1)))) \
        .select("_tf_label", F.col("_tf_cell").alias("_tf_cut"), (F.col("_tf_tests") - F.col("_tf_upto") + F.col("_tf_n")).alias("_tf_take"))
    cuts = materialize(cuts, "split-cuts")
    placed = drawn.join(F.broadcast(cuts), F.col(label_col).eqNullSafe(F.col("_tf_label"))).withColumn("_tf_cell", cell)
    inside = placed.where(F.col("_tf_cell") == F.col("_tf_cut"))
    inside = global_row_number(inside, [F.col(label_col).asc_nulls_first(), F.col("_tf_u"), F.col(key)], "_tf_at")
    firsts = inside.groupBy(F.col(label_col).alias("_tf_label_2")).agg(F.min("_tf_at").alias("_tf_first"))
    inside = inside.join(F.broadcast(firsts), F.col(label_col).eqNullSafe(F.col("_tf_label_2"))) \
        .withColumn(flag, F.col("_tf_at") - F.col("_tf_first") < F.col("_tf_take"))
    outside = placed.where(F.col("_tf_cell") != F.col("_tf_cut")).withColumn(flag, F.col("_tf_cell") < F.col("_tf_cut"))
    cols = [*[c for c in df.columns if c != flag], flag]
    return outside.select(*cols).unionByName(inside.select(*cols))


def stratified_sample(df: DataFrame, label_col: str, targets: dict, key: str = "post_id",
                      seed: str = "0", digits: int = 2) -> DataFrame:
    """Per-label Bernoulli sample sized to about ``targets[label]`` rows.

    fraction(label) = min(1, round(target / rows with that label, digits)),
    computed by one aggregation whose result (one row per listed label) is
    broadcast; each row is kept when its repeatable draw md5(key || seed) falls
    below its label's fraction. Labels not listed and NULL labels are dropped,
    as with ``sampleBy``.
    """
    target = F.create_map(*[x for lab, t in targets.items() for x in (F.lit(lab), F.lit(float(t)))])
    listed = df.where(F.col(label_col).isin(list(targets)))
    frac = listed.groupBy(label_col).agg(F.count(F.lit(1)).alias("_tf_n")).select(
        F.col(label_col).alias("_tf_label"),
        F.least(F.lit(1.0), F.round(F.element_at(target, F.col(label_col)) / F.col("_tf_n"), digits))
        .alias("_tf_frac"))
    j = listed.join(F.broadcast(frac), F.col(label_col) == F.col("_tf_label"), "inner")
    return j.where(uniform01(key, seed) < F.col("_tf_frac")).drop("_tf_label", "_tf_frac")
