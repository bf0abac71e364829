"""Document fingerprints by consistent weighted sampling.

A text's terms are its pairs of neighbouring words in lower case, weighted by their number; a text of fewer than ``SHORT_WORDS`` words
has its character trigrams besides, and one of a single word that word. For each of ``SAMPLES`` samples a term draws r and c from Gamma(2, 1)
and b from the unit interval, all by hash; with weight S its level is t = floor(ln S / r + b), and the term with the least
c / exp(r (t + 1 - b)) is the sample, as (term, t). Two texts have the same sample with the probability of their generalised Jaccard
similarity, sum of the smaller weights over sum of the larger ones. The fingerprint keeps 16 bits of each sample; the
likeness of two is the share of samples that agree, less what 16 bits agree by chance. The fingerprint of a text without words is empty: like
1 to another such, 0 to any other.

``fingerprints`` is the operator. ``neighbour_fingerprints`` also compares each document with the next one and with its edited
text. Documents are put in order by a range partitioning over (doc_id, hash of the text), so that one doc_id with a
third of the rows is spread too, and read in order, one text and its next one at a time. Where a partition ends, its last
text meets the first one of the next partition by an equi-join of one row per partition.

Edge cases: a null or empty text has an empty fingerprint and counts as an empty text for its neighbours; null doc_ids come
first; rows with equal doc_id are ordered by their texts' hash; a single document is its own next one; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustfeed.llm.common import arrow_rows, text_or_empty, texts_of
from trustfeed.session import materialize

SAMPLES = 64
SHORT_WORDS = 8
SAMPLE_BITS = 16
# Number of different (r, b, c) triples, in bits; a term's hash for a sample says which is drawn.
TRIPLE_BITS = 17
# Terms whose draws are made at a time.
TERMS_AT_ONCE = 1024
# Bytes whose words are hashed at a time.
STRETCH = 1 << 16

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xD6E8FEB86659FD93)


def _uniform(n: int, salt: int) -> np.ndarray:
    """n values in (0, 1) by hash."""
    with np.errstate(over="ignore"):
        z = (np.arange(n, dtype=np.uint64) + np.uint64(salt) * _MIX2) * _MIX
        z = (z ^ (z >> np.uint64(32))) * _MIX2
        z = (z ^ (z >> np.uint64(29))) * _MIX
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53


class Draws:
    """The draws of every (term, sample), by hash: one of 2^TRIPLE_BITS triples of two Gamma(2, 1) values and a uniform one."""

    def __init__(self, samples: int):
        n = 1 << TRIPLE_BITS
        self.r = -np.log(_uniform(n, 1) * _uniform(n, 2))
        self.b = _uniform(n, 3)
        self.ln_c = np.log(-np.log(_uniform(n, 4) * _uniform(n, 5)))
        # the term's value ln(c) - r (t + 1 - b) if its weight is 1, as then t = 0
        self.once = (self.ln_c - self.r * (1 - self.b)).astype(np.float32)
        hashes = [xxhash.xxh64_intdigest(b"sample %d" % j) for j in range(samples)]
        self.seeds = np.array(hashes, dtype=np.uint64)
        self.seeds32 = self.seeds.astype(np.uint32)[:, None]
        self.buffers = [np.empty(samples * TERMS_AT_ONCE, dtype=t) for t in (np.uint32, np.uint32, np.intp, np.float32)]

    def least(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per sample the least value, its term and its level; ties go to the smaller term. ``terms`` ascend, weights are positive."""
        n = len(self.seeds)
        best = (np.full(n, np.inf, dtype=np.float32), np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=np.int64))
        for at in range(0, len(terms), TERMS_AT_ONCE):
            best = lesser(best, self._least(terms[at:at + TERMS_AT_ONCE], weights[at:at + TERMS_AT_ONCE]))
        return best

    def _least(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, m = len(self.seeds), len(terms)
        z, shifted, places, value = (b[:n * m].reshape(n, m) for b in self.buffers)
        np.bitwise_xor((terms >> np.uint64(32)).astype(np.uint32)[None, :], self.seeds32, out=z)
        np.multiply(z, np.uint32(0x9E3779B1), out=z)
        np.right_shift(z, np.uint32(15), out=shifted)
        np.bitwise_xor(z, shifted, out=z)
        np.multiply(z, np.uint32(0x85EBCA77), out=z)
        np.right_shift(z, np.uint32(32 - TRIPLE_BITS), out=z)
        places[...] = z
        self.once.take(places, out=value, mode="wrap")
        rows, level = np.arange(n), np.zeros(n, dtype=np.int64)
        more = np.flatnonzero(weights > 1)
        if len(more):
            triple = places[:, more]
            r, b = self.r.take(triple), self.b.take(triple)
            t = np.floor(np.log(weights[more]) / r + b)
            value[:, more] = self.ln_c.take(triple) - r * (t + 1 - b)
        first = value.argmin(axis=1)
        if len(more):
            place = np.full(len(terms), -1)
            place[more] = np.arange(len(more))
            own = place[first]
            level = np.where(own >= 0, t[rows, own], 0).astype(np.int64)
        return value[rows, first], terms[first], level

    def bits(self, best: tuple[np.ndarray, np.ndarray, np.ndarray]) -> bytes:
        """16 bits of each sample (term, level)."""
        _, term, level = best
        key = (term ^ self.seeds) + level.astype(np.uint64) * _MIX
        key = (key ^ (key >> np.uint64(31))) * _MIX2
        return (key >> np.uint64(64 - SAMPLE_BITS)).astype("<u2").tobytes()


def lesser(a: tuple, b: tuple) -> tuple:
    """Sample by sample the one with the lesser value, of equal ones that of the smaller term."""
    take = (a[0] < b[0]) | ((a[0] == b[0]) & (a[1] <= b[1]))
    return tuple(np.where(take, x, y) for x, y in zip(a, b))


class Terms:
    """Hashes of the terms of texts. A word's hash is a polynomial over its bytes, taken for all words of a stretch at once."""

    def __init__(self, short_words: int = SHORT_WORDS):
        self.short_words = short_words
        self.letters = (_uniform(256, 6) * 2.0 ** 53).astype(np.uint64) * _MIX
        self.space = np.zeros(256, dtype=bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self._powers(STRETCH)

    def _powers(self, n: int) -> None:
        """Powers of an odd number modulo 2^64 and of its inverse, so that each word can begin with power 0."""
        with np.errstate(over="ignore"):
            self.up = np.cumprod(np.full(n, _MIX, dtype=np.uint64))
            self.down = np.cumprod(np.full(n, pow(int(_MIX), -1, 1 << 64), dtype=np.uint64))

    def _words(self, body: bytes) -> np.ndarray:
        codes = np.frombuffer(body, dtype=np.uint8)
        if len(codes) > len(self.up):
            self._powers(2 * len(codes))
        edge = np.diff(np.concatenate(([True], self.space[codes], [True])).astype(np.int8))
        starts, ends = np.flatnonzero(edge < 0), np.flatnonzero(edge > 0)
        sums = np.concatenate(([np.uint64(0)], np.cumsum(self.letters[codes] * self.up[:len(codes)])))
        h = (sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64)
        h = (h ^ (h >> np.uint64(32))) * _MIX2
        return h ^ (h >> np.uint64(29))

    def words(self, body: bytes) -> np.ndarray:
        """A stretch ends at a white space; only a longer word makes it longer."""
        parts, start = [np.zeros(0, dtype=np.uint64)], 0
        while start < len(body):
            end = start + STRETCH
            while end < len(body) and not self.space[body[end]]:
                end += 1
            parts.append(self._words(body[start:end]))
            start = end
        return np.concatenate(parts)

    def of(self, text: str) -> np.ndarray:
        body = text.lower().encode()
        with np.errstate(over="ignore"):
            h = self.words(body)
            pairs = (h[:-1] * _MIX + h[1:]) * _MIX2 if len(h) > 1 else h
        if 0 < len(h) < self.short_words:
            whole = b" ".join(body.split()).decode()
            grams = [xxhash.xxh64_intdigest(whole[i:i + 3].encode(), seed=3) for i in range(max(1, len(whole) - 2))]
            pairs = np.concatenate((pairs, np.array(grams, dtype=np.uint64)))
        return pairs


def fingerprint(draws: Draws, terms: np.ndarray) -> bytes:
    """The 16-bit samples of one text's terms as bytes; none for a text without terms."""
    if not len(terms):
        return b""
    return draws.bits(draws.least(*np.unique(terms, return_counts=True)))


def fingerprint_pair(draws: Draws, terms: np.ndarray, others: np.ndarray) -> tuple[bytes, bytes]:
    """The fingerprints of two texts; draws for terms that they have equally often are made once."""
    if not len(terms) or not len(others):
        return fingerprint(draws, terms), fingerprint(draws, others)
    a, n_a = np.unique(terms, return_counts=True)
    b, n_b = np.unique(others, return_counts=True)
    place = np.minimum(np.searchsorted(b, a), len(b) - 1)
    equal_a = (b[place] == a) & (n_b[place] == n_a)
    equal_b = np.zeros(len(b), dtype=bool)
    equal_b[place[equal_a]] = True
    both = draws.least(a[equal_a], n_a[equal_a])
    return (draws.bits(lesser(both, draws.least(a[~equal_a], n_a[~equal_a]))),
            draws.bits(lesser(both, draws.least(b[~equal_b], n_b[~equal_b]))))


def likeness(a: bytes, b: bytes) -> float:
    if not a or not b:
        return float(not a and not b)
    agree = float(np.mean(np.frombuffer(a, dtype="<u2") == np.frombuffer(b, dtype="<u2")))
    chance = 0.5 ** SAMPLE_BITS
    return max(0.0, (agree - chance) / (1 - chance))


def edited(text: str, following: str) -> str:
    """The text, its last half replaced by as much of the beginning of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _name(samples: bytes) -> str:
    return samples.hex()


FINGERPRINT = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id and fingerprint of every row."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draws, terms = Draws(samples), Terms()
        for batch in batches:
            yield arrow_rows([(i, _name(fingerprint(draws, terms.of(t)))) for i, t in texts_of(batch, "doc_id", "text")],
                             FINGERPRINT)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")) \
        .mapInArrow(make, "doc_id bigint, fingerprint string")


# One row per document; the first row of a partition carries its text as head, the last one as tail, its results still open.
ROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fp", pa.binary()),
                 ("edited_fp", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("part", pa.int32()),
                 ("head", pa.string()), ("tail", pa.string())])
ROW_DDL = ("doc_id bigint, n_chars bigint, edited_sha256 string, fp binary, edited_fp binary, near_edited double, "
           "near_next double, part int, head string, tail string")


def _compared(draws: Draws, terms: Terms, row: tuple, following: str, following_fp: bytes | None) -> tuple:
    """The results of one (doc_id, text, head) beside its next text; the last item is its fingerprint."""
    doc_id, text, head, part = row
    other = edited(text, following)
    fp, other_fp = fingerprint_pair(draws, terms.of(text), terms.of(other))
    return (doc_id, len(text), hashlib.sha256(other.encode()).hexdigest(), fp, other_fp, likeness(fp, other_fp),
            None if following_fp is None else likeness(fp, following_fp), part, head, None)


def _along(samples: int):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draws, terms, part = Draws(samples), Terms(), TaskContext.get().partitionId()
        last, done = None, None             # the row before, without its next one; the one before that, without its likeness to that
        for batch in batches:
            out = []
            for doc_id, text in texts_of(batch, "doc_id", "text"):
                if last:
                    row = _compared(draws, terms, last, text, None)
                    if done:
                        out.append(_next_known(done, row[3]))
                    done = row
                last = (doc_id, text, None if last else text, part)
            yield arrow_rows(out, ROW)
        if last:
            fp = fingerprint(draws, terms.of(last[1]))
            end = (last[0], len(last[1]), None, fp, None, None, None, part, last[2], last[1])
            yield arrow_rows([_next_known(done, fp), end] if done else [end], ROW)
    return walk


def _next_known(row: tuple, following_fp: bytes) -> tuple:
    return (*row[:6], likeness(row[3], following_fp), *row[7:])


def _at_ends(samples: int):
    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draws, terms = Draws(samples), Terms()
        for batch in batches:
            yield arrow_rows([_compared(draws, terms, (i, t, None, None), n, fp) for i, t, n, fp in
                              texts_of(batch, "doc_id", "tail", "next_text", "next_fp")], ROW)
    return close


def neighbour_fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and its likeness to that text and to the next document."""
    ordered = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text")) \
        .withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    rows = materialize(ordered.mapInArrow(_along(samples), ROW_DDL), "fingerprints")
    # one row per partition with rows: its first text and fingerprint, known to the partition before it
    heads = rows.where(F.col("head").isNotNull()).select("part", F.col("head").alias("next_text"), F.col("fp").alias("next_fp"))
    parts = heads.select("part")
    first = parts.agg(F.min("part").alias("first")).first()["first"]
    parts = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.lit(first)).alias("next_part"))
    ends = rows.where(F.col("tail").isNotNull()).select("doc_id", "tail", "part").join(parts, "part") \
        .join(heads.withColumnRenamed("part", "next_part"), "next_part").select("doc_id", "tail", "next_text", "next_fp")
    closed = ends.mapInArrow(_at_ends(samples), ROW_DDL)
    every = rows.where(F.col("tail").isNull()).unionByName(closed)
    return every.select("doc_id", "n_chars", "edited_sha256", _text("fp", "fingerprint"), _text("edited_fp", "edited_fingerprint"),
                        "near_edited", "near_next")


def _text(col: str, name: str) -> Column:
    return F.lower(F.hex(col)).alias(name)
