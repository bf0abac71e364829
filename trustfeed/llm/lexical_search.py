"""Ranked lexical search by dense blocked matrix multiplication.

Terms are maximal runs of ASCII letters and digits and of all characters beyond ASCII, A to Z in lower case. Scores are
sums of whole numbers w * impact (weight of the term, saturated frequency in the document), so equal scores are exactly equal.

1. The items are read in blocks of bounded size (``BLOCK_ITEMS``, ``BLOCK_CHARS``), which are sent to all tasks; a
   table of any size takes as many passes as it has blocks. No document is ever joined to an item.
2. One pass over the documents cuts their terms and writes, for each, its length and the frequencies of the block's terms.
   Document counts, the sum of lengths and the terms' document frequencies are aggregated from that table.
3. The written table is read in tiles of ``TILE_DOCS`` documents, the block's items in tiles of ``TILE_ITEMS`` with a
   vocabulary of their own. The documents' impacts over that vocabulary, as a dense matrix, times the item tile's term
   counts, as another, gives all scores of the two tiles in one BLAS call of float64. An item tile's vocabulary is cut
   into strips whose sums stay below 2^53, whatever the documents, so that each product is exact; strips add up
   as 64-bit integers.
4. A task keeps the best ``k`` documents of every item, ties by doc_id, and hands on only those; they meet by item in two steps.

Edge cases: null and empty texts have no terms, so such items have no result rows and such documents none either; ties go to the
smaller doc_id, a null doc_id last; repeated documents take places of their own; each row of the items counts as
an item, also with an id that another has; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustfeed.llm.common import arrow_rows, texts_of
from trustfeed.session import materialize

BEST = 10
BLOCK_ITEMS, BLOCK_CHARS = 2048, 1 << 23
TILE_DOCS, TILE_ITEMS = 512, 32
EXACT = 1 << 53
# Impacts are below this: (10^9 tf) div (1000 tf + 8 m) with m > 0.
MOST_IMPACT = 10**6
LENGTH_SHARE = 75
SALTS = 32

# Separators become blanks, A-Z lower case; bytes of characters beyond ASCII stay.
_FOLD = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 32
              for c in range(256))

POSTINGS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tf", pa.list_(pa.int64()))])
POSTINGS_DDL = "doc_id bigint, n bigint, terms array<int>, tf array<bigint>"
HITS = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64()), ("salt", pa.int64())])
HITS_DDL = "item bigint, doc_id bigint, score bigint, salt bigint"


def terms_of(body: bytes) -> list[bytes]:
    return body.translate(_FOLD).split()


def _body() -> Column:
    return F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body")


def _postings(vocabulary: dict[bytes, int]) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for batch in batches:
            rows = []
            for doc_id, body in texts_of(batch, "doc_id", "body"):
                terms = terms_of(body)
                if terms:
                    held = Counter(map(number, terms))
                    held.pop(None, None)
                    rows.append((doc_id, len(terms), list(held), list(held.values())))
            yield arrow_rows(rows, POSTINGS)
    return cut


class ItemTile:
    """Some items over their own vocabulary: counts as a dense matrix, cut into strips of terms whose products are exact."""

    def __init__(self, numbers: list[int], counts: list[dict[int, int]], weights: np.ndarray):
        self.numbers = np.array(numbers, dtype=np.int64)
        self.terms = np.array(sorted({t for c in counts for t in c}), dtype=np.int64)
        place = {t: i for i, t in enumerate(self.terms.tolist())}
        self.counts = np.zeros((len(self.terms), len(counts)))
        for j, c in enumerate(counts):
            for t, n in c.items():
                self.counts[place[t], j] = n
        self.strips = list(exact_strips(self.counts, weights[self.terms]))
        self.column = np.full(len(weights), -1, dtype=np.int64)
        self.column[self.terms] = np.arange(len(self.terms))

    def scores(self, rows: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_docs: int) -> np.ndarray:
        """Documents x items, from (document row, term, w * impact) triples."""
        column = self.column[terms]
        mine = column >= 0
        dense = np.zeros((n_docs, len(self.terms)))
        dense[rows[mine], column[mine]] = impacts[mine]
        return sum((dense[:, at] @ counts).astype(np.int64) for at, counts in self.strips)


def exact_strips(counts: np.ndarray, weights: np.ndarray) -> Iterator[tuple[slice, np.ndarray]]:
    """The rows of ``counts`` in strips (where, counts) whose products with w * impact stay below 2^53 in every sum.

    A term that an item repeats too often for that is a strip of its own, several times, with a part of its count each.
    """
    unit = np.maximum(weights, 1) * MOST_IMPACT
    most = counts.max(axis=1, initial=0) * unit
    start, total = 0, 0.0
    for i, m in enumerate(most.tolist()):
        if total + m >= EXACT:
            if i > start:
                yield slice(start, i), counts[start:i]
            start, total = i, 0.0
        if m >= EXACT:
            rest, part = counts[i:i + 1].copy(), float((EXACT - 1) // int(unit[i]))
            while rest.any():
                taken = np.minimum(rest, part)
                yield slice(i, i + 1), taken
                rest -= taken
            start = i + 1
        else:
            total += m
    if start < len(counts):
        yield slice(start, len(counts)), counts[start:]


def order_of_hits(ids: np.ndarray, known: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Highest score first, ties by ascending id, unknown ids last."""
    return np.lexsort((ids, ~known, -scores))


class Best:
    """The best ``k`` hits of one item so far."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.ids, self.known, self.scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool), np.zeros(0, dtype=np.int64)

    def add(self, ids: np.ndarray, known: np.ndarray, scores: np.ndarray) -> None:
        ids, known, scores = (np.concatenate(x) for x in ((self.ids, ids), (self.known, known), (self.scores, scores)))
        by = order_of_hits(ids, known, scores)[:self.k]
        self.ids, self.known, self.scores = ids[by], known[by], scores[by]
        if len(by) == self.k:
            self.least = max(1, int(self.scores[-1]))      # a hit of equal score may still have a smaller id


def _search(tiles: list[ItemTile], weights: np.ndarray, n_docs: int, n_terms: int, k: int, tile_docs: int) -> Callable:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {int(i): Best(k) for tile in tiles for i in tile.numbers}
        for batch in batches:
            for start in range(0, batch.num_rows, tile_docs):
                _score_tile(batch.slice(start, tile_docs), tiles, weights, n_docs, n_terms, best)
        salt = TaskContext.get().partitionId() % SALTS
        yield arrow_rows([(i, d if w else None, s, salt) for i, b in best.items()
                          for d, w, s in zip(b.ids.tolist(), b.known.tolist(), b.scores.tolist())], HITS)
    return search


def _score_tile(docs: pa.RecordBatch, tiles: list[ItemTile], weights: np.ndarray, n_docs: int, n_terms: int, best: dict) -> None:
    ids, n, lists, counts = (docs.column(docs.schema.get_field_index(c)) for c in ("doc_id", "n", "terms", "tf"))
    known = np.asarray(ids.is_valid().to_numpy(zero_copy_only=False))
    ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
    # Python's whole numbers: N times a length may leave 64 bits
    m = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * x * n_docs // n_terms for x in n.to_pylist()], dtype=np.int64)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(ids)), sizes)
    terms = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    tf = counts.flatten().to_numpy(zero_copy_only=False)
    impacts = (weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[rows]))).astype(np.float64)
    for tile in tiles:
        scores = tile.scores(rows, terms, impacts, len(ids))
        items = tile.numbers.tolist()
        enough = scores >= np.array([best[i].least for i in items])
        for j in np.flatnonzero(enough.any(axis=0)).tolist():
            hit = enough[:, j]
            best[items[j]].add(ids[hit], known[hit], scores[hit, j])


def _blocks(items: DataFrame, block_items: int, block_chars: int) -> Iterator[list[tuple]]:
    """The items with terms, in blocks of bounded size: (id, terms with their counts); a block at a time is on the driver."""
    size = items.agg(F.count(F.lit(1)), F.sum(F.length("body"))).first()
    blocks = max(1, math.ceil(size[0] / block_items), math.ceil((size[1] or 0) / block_chars))
    numbered = items.withColumn("block", F.pmod(F.xxhash64("item_id", "body"), F.lit(blocks)))
    for b in range(blocks):
        rows = [(r["item_id"], Counter(terms_of(bytes(r["body"])))) for r in
                numbered.where(F.col("block") == b).select("item_id", "body").collect()]
        yield [r for r in rows if r[1]]


def _block_hits(docs: DataFrame, block: list[tuple], k: int, tile_docs: int, tile_items: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, c in block for t in c}))}
    postings = materialize(docs.mapInArrow(_postings(vocabulary), POSTINGS_DDL), "postings")
    n_docs, n_terms = postings.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for r in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[r["term"]] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], dtype=np.int64)
    numbered = [{vocabulary[t]: n for t, n in c.items()} for _, c in block]
    # items that share terms lie near each other
    near = sorted(range(len(numbered)), key=lambda i: sorted(numbered[i]))
    tiles = [ItemTile(near[i:i + tile_items], [numbered[j] for j in near[i:i + tile_items]], weights)
             for i in range(0, len(near), tile_items)]
    hits = postings.mapInArrow(_search(tiles, weights, n_docs, n_terms or 1, k, tile_docs), HITS_DDL)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for group in (["item", "salt"], ["item"]):
        hits = hits.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], "item bigint, item_id bigint")
    return hits.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def lexical_search(docs: DataFrame, items: DataFrame, k: int = BEST, block_items: int = BLOCK_ITEMS, block_chars: int = BLOCK_CHARS,
                   tile_docs: int = TILE_DOCS, tile_items: int = TILE_ITEMS) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: item_id, rank, doc_id, score."""
    bodies = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _body())
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), _body())
    found = [_block_hits(bodies, block, k, tile_docs, tile_items) for block in _blocks(items, block_items, block_chars) if block]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, found)
