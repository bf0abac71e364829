"""Exact global ``ROW_NUMBER() OVER (ORDER BY ...)`` without a single-task window.

A window without PARTITION BY moves every row into one task. Instead:

1. ``orderBy`` range-partitions on the full (unique) sort key - Spark samples
   the composite key, so even a value shared by a third of the rows is split
   across tasks by the tie-break column - and sorts each partition;
2. ``monotonically_increasing_id`` records (partition index, position);
3. the numbered rows are written once to the shared checkpoint folder, which
   fixes the numbering (it is nondeterministic on recomputation, e.g. after a
   lost executor) and serves both the counts and the final join;
4. rows per partition are counted (one row per partition) and turned into
   running offsets, which are broadcast - their size is bounded by the number
   of partitions, not by the data;
5. rank = offset of the partition + position + 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustfeed.session import materialize

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def global_row_number(df: DataFrame, order_cols: list[Column], name: str = "rank",
                      start: int = 1) -> DataFrame:
    """Add ``name`` = position in the total order ``order_cols`` (``start``-based).

    ``order_cols`` must form a unique key (add the id as last key) so the
    numbering is well defined.
    """
    numbered = df.orderBy(*order_cols).withColumn("_tf_mid", F.monotonically_increasing_id())
    numbered = materialize(numbered, "numbered")
    numbered = numbered.withColumn("_tf_pid", F.shiftrightunsigned("_tf_mid", _POS_BITS))

    counts = numbered.groupBy("_tf_pid").agg(F.count(F.lit(1)).alias("_tf_n"))
    before = Window.orderBy("_tf_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_tf_pid", F.coalesce(F.sum("_tf_n").over(before), F.lit(0)).alias("_tf_off"))

    pos = F.col("_tf_mid").bitwiseAND(F.lit(_POS_MASK))
    out = numbered.join(F.broadcast(offsets), "_tf_pid", "inner")
    return out.withColumn(name, (F.col("_tf_off") + pos + F.lit(start)).cast("bigint")) \
        .drop("_tf_pid", "_tf_mid", "_tf_off")
