"""Top-k by a threshold (F2).

``orderBy(...).limit(k)`` keeps k rows in every map task and merges all of them in one task: k times the number of
map tasks. Here a quantile sketch of the order key (``percentile_approx``, mergeable, its rank error a known share of the
rows) proposes a bound, an exact count confirms that at least k rows reach it, and the rows that do are the input of the
next pass, until they are near k. Where very many rows share the bound's value, the smallest ids among them are found by a
range-partitioned numbering of their ids. What is left is a filter with literal bounds, so rows near k in
number reach the final sort, whatever the number of map tasks.

The score is compared as a double; it sorts descending, nulls and NaN come last, ties go by ascending id; rows with equal
score and id are equal for the order, and any of them may be the last one kept. Null ids come first among equals. An empty
table and k = 0 give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustfeed.operators.global_rank import global_row_number
from trustfeed.session import materialize

# Rank error of the sketch: rows / ACCURACY.
ACCURACY = 10_000
# A pass ends the search once so many times k rows are left.
NEAR = 2
# Quantiles asked for in the pass over all rows, whose number isn't known before: 1 - 2^-j.
HALVINGS = 40


def _value(score: str) -> Column:
    v = F.col(score).cast("double")
    return F.when(~F.isnan(v), v)


def _quantile(left: int, k: int) -> float:
    """The quantile above which k of ``left`` rows stay whatever the sketch's error."""
    return max(0.0, 1.0 - (k + 2.0 * left / ACCURACY + 1) / left)


def _ids_up_to(rows: DataFrame, key: str, n: int):
    """The n-th smallest id of ``rows``."""
    ranked = global_row_number(rows.select(key), [F.col(key).asc()], "_tf_at")
    return ranked.where(F.col("_tf_at") == n).select(key).first()[0]


def _up_to(key: str, bound) -> Column:
    return F.col(key).isNull() if bound is None else F.col(key).isNull() | (F.col(key) <= F.lit(bound))


def top_k_filter(df: DataFrame, score: str, key: str, k: int) -> Column | None:
    """A condition that all of the top k rows of ``df`` meet, and not many others; None: every row may be needed."""
    if k <= 0:
        return F.lit(False)
    value = _value(score)
    cuts = [1.0 - 0.5 ** j for j in range(1, HALVINGS + 1)]
    n, valued, quantiles = df.agg(F.count(F.lit(1)), F.count(value), F.percentile_approx(value, cuts, ACCURACY)).first()
    if n <= NEAR * k:
        return None
    if valued <= k:      # all rows with a score, and the smallest ids of those without
        if valued == k:
            return value.isNotNull()
        nulls = materialize(df.where(value.isNull()).select(key), "top-nulls")
        return value.isNotNull() | _up_to(key, _ids_up_to(nulls, key, k - valued))
    narrow = df.where(value.isNotNull()).select(value.alias("_tf_v"), key)
    # the highest of the first cuts that leaves k rows beyond the sketch's error; the count confirms it
    safe = [q for c, q in zip(cuts, quantiles) if c <= _quantile(valued, k)]
    needed = value >= F.lit(safe[-1]) if safe else value.isNotNull()
    left = materialize(narrow.where(F.col("_tf_v") >= F.lit(safe[-1])) if safe else narrow, "top-candidates")
    n = left.count()
    if n < k:
        needed, left, n = value.isNotNull(), materialize(narrow, "top-candidates"), valued
    while n > NEAR * k:
        q, above, at = _quantile(n, k), 0, 0
        while above + at < k:       # true at once, unless the sketch errs by more than it states
            bound = left.agg(F.percentile_approx("_tf_v", q, ACCURACY)).first()[0]
            above, at = left.agg(F.count(F.when(F.col("_tf_v") > F.lit(bound), 1)),
                                 F.count(F.when(F.col("_tf_v") == F.lit(bound), 1))).first()
            if above + at < k and q == 0.0:
                return needed
            q = max(0.0, 1.0 - 2 * (1.0 - q))
        if above >= k:              # rows at the bound aren't needed
            needed, left, n = value > F.lit(bound), left.where(F.col("_tf_v") > F.lit(bound)), above
        elif above + at <= NEAR * k:
            return value >= F.lit(bound)
        else:                       # too many ties: the smallest ids among them
            last = _ids_up_to(left.where(F.col("_tf_v") == F.lit(bound)), key, k - above)
            return (value > F.lit(bound)) | ((value == F.lit(bound)) & _up_to(key, last))
    return needed


def top_k(df: DataFrame, score: str, key: str, k: int) -> DataFrame:
    """The k rows with the highest score, ties by ascending id, in that order."""
    needed = top_k_filter(df, score, key, k)
    rows = df if needed is None else df.where(needed)
    return rows.orderBy(_value(score).desc_nulls_last(), F.col(key).asc()).limit(max(k, 0))
