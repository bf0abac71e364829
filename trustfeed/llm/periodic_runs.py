"""Periodic runs of words, found by internal pattern matching.

A run is a stretch of words with smallest period q and at least ``max(6, 4 q)`` words that can't be extended with that period.
A run of period q with 2^(k-1) < q <= 2^k holds an aligned block of 2^k words (for q = 1 one of two words), and the block
occurs again q words later or earlier within the run, and nowhere nearer. So for every k the aligned blocks of 2^k words are
taken as patterns: the suffix array gives the interval of the suffixes that begin with the block, and a wavelet tree over the
suffix array answers which of them is the next in the text after the block's own place and which the last before it. The
occurrences in such a neighbouring window form an arithmetic progression, whose difference is the candidate period. A
candidate is extended to both sides by the ranks of the dyadic substrings, from which the suffix array was made, and is
a run if it is long enough. A block that occurs once has no candidate.

A task reads its documents in groups of some ``GROUP_WORDS`` words and treats a group as one sequence whose documents have
alphabets of their own, so that no two documents share a substring. Work is O(n log n) for n words; nothing is shuffled, and
memory follows the group, or the longest text if that is longer.

Edge cases: a null or empty text has no words and no run, the hash of nothing, and nulls for its best run; a row with a null
doc_id is never made periodic; repeated rows give the same results each; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustfeed.llm.common import arrow_rows, texts_of

LEAST_WORDS = 6
LEAST_PERIODS = 4
GROUP_WORDS = 1 << 17

OUT = pa.schema([("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                 ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()),
                 ("collapsed_sha256", pa.string())])
OUT_DDL = ("doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
           "runs_sha256 string, collapsed_sha256 string")


def suffix_ranks(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array by prefix doubling, and for each k the ranks of the substrings of 2^k symbols.

    A rank is the first place in the suffix array of the suffixes that begin with the substring. The last ranks are those
    of the whole suffixes.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ranks = [_group_starts(order, symbols[order])]
    slots = np.arange(n)
    width = 1
    while True:
        rank = ranks[-1]
        sizes = np.bincount(rank, minlength=n)
        slots = slots[sizes[rank[order[slots]]] > 1]
        if not len(slots) or width >= n:
            return order, ranks
        open_ = order[slots]
        after = open_ + width
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[open_] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        order[slots] = open_[by]
        key = key[by]
        first = np.concatenate(([True], key[1:] != key[:-1]))
        finer = rank.copy()
        finer[order[slots]] = slots[np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))]
        ranks.append(finer)
        width *= 2


def _group_starts(order: np.ndarray, keys: np.ndarray) -> np.ndarray:
    n = len(order)
    starts = np.zeros(n, dtype=np.int64)
    if n:
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        starts[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    return starts


class WaveletTree:
    """Wavelet tree (its levels as one row each) over places: order statistics of any stretch, for arrays of queries."""

    def __init__(self, places: np.ndarray):
        self.bits = max(1, int(len(places)).bit_length())
        self.zeros = []
        for b in reversed(range(self.bits)):
            one = (places >> b) & 1 == 1
            self.zeros.append(np.concatenate(([0], np.cumsum(~one))))
            places = np.concatenate((places[~one], places[one]))

    def smaller(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many places in [low, high) are smaller than x."""
        count = np.zeros(len(low), dtype=np.int64)
        for b, zeros in zip(reversed(range(self.bits)), self.zeros):
            one = (x >> b) & 1 == 1
            zl, zh, all_zeros = zeros[low], zeros[high], zeros[-1]
            count += np.where(one, zh - zl, 0)
            low, high = np.where(one, all_zeros + low - zl, zl), np.where(one, all_zeros + high - zh, zh)
        return count

    def kth(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The place of rank k (from 0) in [low, high)."""
        value = np.zeros(len(low), dtype=np.int64)
        for b, zeros in zip(reversed(range(self.bits)), self.zeros):
            zl, zh, all_zeros = zeros[low], zeros[high], zeros[-1]
            one = k >= zh - zl
            value |= np.where(one, 1 << b, 0)
            k = np.where(one, k - (zh - zl), k)
            low, high = np.where(one, all_zeros + low - zl, zl), np.where(one, all_zeros + high - zh, zh)
        return value


def _reach(ranks: list[np.ndarray], i: np.ndarray, j: np.ndarray, back: bool) -> np.ndarray:
    """How many symbols agree from places i and j on, or before them."""
    n, total = len(ranks[0]), np.zeros(len(i), dtype=np.int64)
    for k in reversed(range(len(ranks))):
        width = 1 << k
        a, b = (i - total - width, j - total - width) if back else (i + total, j + total)
        inside = (a >= 0) & (b + width <= n)
        same = inside & (ranks[k][np.where(inside, a, 0)] == ranks[k][np.where(inside, b, 0)])
        total += np.where(same, width, 0)
    return total


def find_runs(symbols: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> np.ndarray:
    """(start, end, period) of every run, by start and period."""
    none = np.zeros((0, 3), dtype=np.int64)
    n = len(symbols)
    if n < 2:
        return none
    order, ranks = suffix_ranks(symbols)
    if len(ranks) < 2:
        return none
    tree, found = WaveletTree(order), []
    for k in range(1, len(ranks)):
        width = 1 << k
        at = np.arange(0, n - width + 1, width)
        low = ranks[k][at]
        size = np.bincount(ranks[k], minlength=n)[low]
        at, low, size = at[size > 1], low[size > 1], size[size > 1]
        if not len(at):
            continue
        own = tree.smaller(low, low + size, at)
        nearest = 1 if k == 1 else width // 2 + 1
        has_next, has_last = own + 1 < size, own > 0
        q = tree.kth(low[has_next], (low + size)[has_next], own[has_next] + 1) - at[has_next]
        fits = (q >= nearest) & (q <= width)
        found.append(_extended(ranks, at[has_next][fits], q[fits]))
        q = at[has_last] - tree.kth(low[has_last], (low + size)[has_last], own[has_last] - 1)
        fits = (q >= nearest) & (q <= width)
        found.append(_extended(ranks, (at[has_last] - q)[fits], q[fits]))
    runs = np.concatenate(found) if found else none
    length, period = runs[:, 1] - runs[:, 0], runs[:, 2]
    runs = runs[(length >= least_words) & (length >= least_periods * period)]
    runs = np.unique(runs, axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _extended(ranks: list[np.ndarray], i: np.ndarray, q: np.ndarray) -> np.ndarray:
    j = i + q
    return np.stack((i - _reach(ranks, i, j, True), j + _reach(ranks, i, j, False), q), axis=1)


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """For every tenth document by the checksum of its id: the word that stands at each place, periodic from some place on."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def _group_rows(docs: list[tuple[int | None, list[bytes]]]) -> list[tuple]:
    """The result rows of some documents, all their words being one sequence."""
    known: dict[bytes, int] = {}
    parts = []
    for number, (doc_id, words) in enumerate(docs):
        ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))
        places = planted(doc_id, len(words))
        if places is not None:
            ids = ids[places]
            docs[number] = (doc_id, [words[i] for i in places.tolist()])
        parts.append(ids)
    lengths = [len(p) for p in parts]
    starts = np.concatenate(([0], np.cumsum(lengths)))
    owner = np.repeat(np.arange(len(docs)), lengths)
    symbols = owner * (len(known) + 1) + np.concatenate([*parts, np.zeros(0, dtype=np.int64)])
    runs = find_runs(symbols)
    gone = np.zeros(starts[-1] + 1, dtype=np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 1], -1)
    kept = np.cumsum(gone)[:-1] == 0
    of = np.searchsorted(starts, runs[:, 0], side="right") - 1
    first_run = np.searchsorted(of, np.arange(len(docs) + 1))
    return [_row(doc_id, words, runs[first_run[i]:first_run[i + 1]] - [starts[i], starts[i], 0], kept[starts[i]:starts[i + 1]])
            for i, (doc_id, words) in enumerate(docs)]


def _row(doc_id: int | None, words: list[bytes], runs: np.ndarray, kept: np.ndarray) -> tuple:
    if not len(runs):
        return (doc_id, 0, None, None, None, None, hashlib.sha256().hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest())
    found = [(s, e - s, q) for s, e, q in runs.tolist()]
    start, length, period = found[0]
    for s, n, q in found[1:]:
        if n * period > length * q:         # ties stay with the smaller start, then period
            start, length, period = s, n, q
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    rest = b" ".join([w for w, k in zip(words, kept.tolist()) if k])
    return (doc_id, len(found), start, length, period, 1000 * length // period,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(rest).hexdigest())


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs, n = [], 0
    for batch in batches:
        for doc_id, body in texts_of(batch, "doc_id", "body"):
            words = body.split()            # of bytes: at ASCII white space
            if docs and n + len(words) > GROUP_WORDS:
                yield arrow_rows(_group_rows(docs), OUT)
                docs, n = [], 0
            docs.append((doc_id, words))
            n += len(words)
    if docs:
        yield arrow_rows(_group_rows(docs), OUT)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per document with the number of its runs, the best run, and hashes of the runs and of the text without repeats."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), body.alias("body")).mapInArrow(_runs, OUT_DDL)
