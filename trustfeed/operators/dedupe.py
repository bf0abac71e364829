"""De-duplication by key.

One survivor per key is chosen with ``min_by(struct(row), struct(order))`` in
a ``groupBy``: the aggregate is combined map-side before the shuffle, so a key
that holds a third of all rows still sends one row per map task, unlike a
``row_number`` window that sorts the whole hot key in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

_ROW = "_tf_row"


def _order_expr(df: DataFrame, spec) -> F.Column:
    """``'col'`` ascending, ``'-col'`` descending (numeric, date or timestamp)."""
    if not isinstance(spec, str):
        return spec
    if not spec.startswith("-"):
        return F.col(spec)
    name = spec[1:]
    dtype = df.schema[name].dataType
    if isinstance(dtype, NumericType):
        return -F.col(name)
    if isinstance(dtype, StringType):
        raise ValueError(f"descending order on string column {name!r} is not supported")
    # date / timestamp: order by the negated epoch value
    return -F.unix_micros(F.col(name).cast("timestamp"))


def dedupe_by_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Keep, per ``keys``, the row that comes first in ``order``.

    ``order`` items are column names (ascending) or ``'-name'`` (descending);
    add a unique column last for a deterministic survivor.
    """
    cols = df.columns
    ord_struct = F.struct(*[_order_expr(df, o).alias(f"_o{i}") for i, o in enumerate(order)])
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*cols), ord_struct).alias(_ROW))
    return agg.select(*[F.col(f"{_ROW}.{c}").alias(c) for c in cols])


def duplicate_keys(df: DataFrame, keys: list[str], count_name: str = "count") -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).where(F.col(count_name) > 1)


def latest_per_post(df: DataFrame, key: str = "post_id", time_col: str = "dtime",
                    tie_break: list[str] | None = None) -> DataFrame:
    """The newest row of each post (largest ``time_col``); then ``tie_break``, then a hash of the whole row."""
    return dedupe_by_key(df, [key], [f"-{time_col}", *(tie_break or []), F.xxhash64(*df.columns)])
