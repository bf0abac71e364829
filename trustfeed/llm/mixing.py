"""Mixing sources to target weights by systematic sampling.

Sources in code-point order (null last) weigh 3, 1, 2, 3, 1, 2, ... and share 150 % of all words. A target stops
at twice its source's words; what it leaves is shared again by weight until no target is above. That is a water
level L with target = min(2 * words, L * weight), found from the running sums over sources ordered by words / weight.

Within a source every document has the same expected number of copies r = target / words (at most 2). The documents
are ordered by size, their expected copies are summed from the first on, one offset u per source is added, and a
document is emitted once for each integer that its interval crosses: floor(u + k r) - floor(u + (k-1) r) times.
Ordered by size, the words taken differ from the target by no more than about the largest document's size.

The order runs over all documents (range partitioning on source, size and id), not over one source per task, so a
source with a third of all rows is spread like any other. Only one row per source is ever held together.

Edge cases: a null text has size 0; null sources form a source of their own, the last; documents without words
are listed with r copies of nothing (taken 0); ties and repeated rows are separate documents; a source without words
has target 0; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from trustfeed.llm.common import fresh, n_words, text_or_empty
from trustfeed.operators.global_rank import global_row_number
from trustfeed.session import materialize

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_COPIES = 2


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share_percent: int = SHARE_PERCENT,
                   most: int = MOST_COPIES) -> DataFrame:
    """From (source, size) rows: one row per source with its words, rows, target, rate, offset and first rank."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"),
                                          F.count(F.lit(1)).alias("source_rows"))
    n = len(weights)
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(by_name) - 1) % n + 1).cast("int"))
    sources = sources.select(
        "*", pick.cast("bigint").alias("weight"),
        F.coalesce(F.sum("source_rows").over(by_name.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .cast("bigint").alias("rows_before"))
    # sources reach their cap in the order of words / weight
    by_cap = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    earlier, later = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    sources = sources.select(
        "*", F.coalesce(F.sum("source_size").over(earlier), F.lit(0)).alias("capped"),
        F.sum("weight").over(later).alias("open_weight"),
        F.sum("source_size").over(everything).alias("all_size"))
    level = (F.lit(share_percent / 100.0) * F.col("all_size") - F.lit(most) * F.col("capped")) / F.col("open_weight")
    # the level is that of the first source which stays below its cap; later ones would give lower levels
    below = level * F.col("weight") < F.lit(most) * F.col("source_size")
    sources = sources.withColumn("level", F.max(F.when(below, level)).over(everything))
    cap = (F.lit(most) * F.col("source_size")).cast("double")
    target = F.least(cap, F.coalesce(F.col("level") * F.col("weight"), cap))
    offset = F.conv(F.substring(F.md5(F.coalesce(F.col("source"), F.lit("\x00"))), 1, 8), 16, 10).cast("double") \
        / F.lit(4294967296.0)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return sources.select("source", "source_size", "rows_before", target.alias("target"), offset.alias("u")) \
        .withColumn("rate", rate)


def mix_sources(docs: DataFrame, weights: tuple = WEIGHTS, share_percent: int = SHARE_PERCENT,
                most: int = MOST_COPIES) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken (= copies * size).

    Rows: every document, also those not drawn (copies 0).
    """
    # written first: the order samples its input before it sorts it, and would count the words twice
    sized = materialize(docs.select("doc_id", "source", n_words(text_or_empty()).alias("size")), "mix-sizes")
    ranked = global_row_number(sized, [F.col("source").asc_nulls_last(), F.col("size").desc(), F.col("doc_id")], "at")
    ranked = materialize(ranked, "mix-ranked")
    targets = source_targets(ranked.select("source", "size"), weights, share_percent, most) \
        .withColumnRenamed("source", "source_")
    rows = ranked.join(targets, F.col("source").eqNullSafe(F.col("source_")))
    k = F.col("at") - F.col("rows_before")
    copies = F.floor(F.col("u") + k * F.col("rate")) - F.floor(F.col("u") + (k - 1) * F.col("rate"))
    copies = F.least(copies, F.lit(most)).cast("bigint")
    return rows.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                       (copies * F.col("size")).cast("bigint").alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple = WEIGHTS, share_percent: int = SHARE_PERCENT,
                    most: int = MOST_COPIES) -> DataFrame:
    """The mix itself: the documents with all their columns, each repeated as often as it was drawn.

    Documents are found again by (doc_id, source, size, number among equals); of rows that agree in these, those
    with the smaller hash of all their columns are drawn more often.
    """
    names = {x: fresh(docs, f"_mix_{x}") for x in ("size", "n", "copies", "i")}
    size, n, i = names["size"], names["n"], names["i"]

    def numbered(df, size, *order):
        same = Window.partitionBy("doc_id", "source", size).orderBy(*order)
        return df.withColumn(n, F.row_number().over(same))
    drawn = numbered(mix_sources(docs, weights, share_percent, most), "size", F.col("copies").desc()).where("copies > 0") \
        .select(F.col("doc_id").alias("d_"), F.col("source").alias("s_"), F.col("size").alias("z_"),
                F.col(n).alias("n_"), "copies")
    hashed = [F.to_json(F.struct(F.col(f"`{f.name}`"))) if isinstance(f.dataType, (MapType, ArrayType, StructType)) else F.col(f"`{f.name}`")
              for f in docs.schema]       # a map can't be hashed, also not within other types
    rows = numbered(docs.withColumn(size, n_words(text_or_empty())), size, F.xxhash64(*hashed))
    rows = rows.alias("a").join(
        drawn.alias("b"),
        F.col(f"a.{size}").eqNullSafe(F.col("b.z_")) & (F.col(f"a.{n}") == F.col("b.n_"))
        & F.col("a.doc_id").eqNullSafe(F.col("b.d_")) & F.col("a.source").eqNullSafe(F.col("b.s_")))
    copies = F.explode(F.sequence(F.lit(1), F.col("b.copies"))).alias(i)
    return rows.select(*[F.col(f"a.`{c}`") for c in docs.columns], copies).select(*[f"`{c}`" for c in docs.columns])
