"""Shared pieces of the text operators: word pattern, column guards, temporary names."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it (case-insensitive, as Spark resolves)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def arrow_rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """Rows as a record batch (integers stay integers beside nulls, unlike in pandas)."""
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def texts_of(batch: pa.RecordBatch, *names: str):
    """Tuples of the named columns, a row at a time."""
    return zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names))


# Bits of a hash bitmap: BITMAPS rows of 4 kB each, whatever it is made of.
BITMAPS, BITMAP_BITS = 1024, 32768


def maybe_in(df: DataFrame, col: str, keys: DataFrame, missing: bool = False) -> DataFrame:
    """The rows of ``df`` whose 64-bit hash ``col`` may be in the one column of ``keys``: all that are, and few others.

    With ``missing`` the other rows: those whose hash is certainly not among the keys.

    The hashes become a bitmap of fixed size (4 MB), which is broadcast, so rows without partner needn't be
    shuffled for the exact join that has to follow. With very many keys the bitmap fills up and lets all rows pass.
    """
    part, place, bits = (fresh(df, f"_bitmap_{x}") for x in ("part", "place", "bits"))

    def spread(c):
        return F.pmod(c, F.lit(BITMAPS)).cast("int"), F.pmod(F.shiftright(c, 20), F.lit(BITMAP_BITS)).cast("bigint")
    k_part, k_place = spread(F.col(keys.columns[0]))
    maps = keys.select(k_part.alias(part), k_place.alias(place)).groupBy(part).agg(F.bitmap_construct_agg(place).alias(bits))
    d_part, d_place = spread(F.col(col))
    joined = df.withColumns({part: d_part, place: d_place}).join(F.broadcast(maps), part, "left")
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.pmod(F.call_function("shiftright", byte, F.col(place).bitwiseAND(F.lit(7)).cast("int")), F.lit(2)) == 1
    found = F.coalesce(is_set, F.lit(False))
    return joined.where(~found if missing else found).select(*[F.col(f"`{c}`") for c in df.columns])
