"""Packing documents into sequences of a fixed length by swap-based local search.

Documents are tokenized whole; each ends with token id 0. Documents longer than a sequence are cut into
full-length pieces, the last of which may be shorter. The pieces are dealt to groups of about ``group_pieces`` by a hash
(the number of groups grows with the data; a group's size does not), and every group is packed on its own:

1. best fit, longest first, puts each piece into the fullest sequence that has room for it;
2. local search among underfull sequences: a piece moves, is exchanged for a longer one, or for two, so that the
   fuller sequence of the two becomes still fuller. Each step raises the sum of squared fills; sequences that run empty
   are dropped.

A group loses at most its last underfull sequence against packing everything at once.

Only (doc_id, piece, start, length, crc) travels; the tokens themselves are never shuffled. A lost task repeats with the
same result, since group and order depend on the rows alone.

Edge cases: null and empty texts are one piece of length 1 (the end token); repeated rows are packed each on its own; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustfeed.llm.common import arrow_rows, texts_of
from trustfeed.session import materialize

MAX_TOKENS = 2048
GROUP_PIECES = 20_000
ROUNDS = 8
END = (0).to_bytes(4, "little")
# Caches of a task: words, parts of words, and the longest word that they hold.
CACHE_WORDS, CACHE_PARTS, CACHE_CHARS = 300_000, 600_000, 48
PIECES_DDL = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED_DDL = PIECES_DDL + ", group_id int, bin int, offset bigint"
PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64())])
# White space for Python's str.split() that the tokenizer's \s doesn't cover.
_NOT_SPACE = "\x1c\x1d\x1e\x1f"
# ASCII signs and letters, and Latin letters whose lower case is one letter (no multiplication or division sign).
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e]+")
# The tokenizer's own split pattern, for such characters.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00c0-\u017e]+|[0-9]|[^a-z0-9\u00c0-\u017e]+")
# Byte-level vocabularies show printable bytes as themselves and the others as characters from U+0100 on.
_SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_CHARS = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}


class WordIds(dict):
    """Word -> its token ids as little-endian 32-bit integers.

    The tokenizer never joins characters across white space, so a text's ids are those of its words in a row. Words of
    plain Latin letters, digits and signs are split into the tokenizer's pre-tokens here, whose merges are cached, too;
    all other words go through the tokenizer itself.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.merge, self.parts = tokenizer, tokenizer.model.tokenize, {}

    def encode(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, dtype="<u4").tobytes()

    def part(self, part: str) -> bytes:
        if (out := self.parts.get(part)) is None:
            seen = part.encode().decode("latin-1").translate(_BYTE_CHARS)
            out = b"".join(t.id.to_bytes(4, "little") for t in self.merge(seen))
            if len(part) <= CACHE_CHARS:
                if len(self.parts) >= CACHE_PARTS:
                    self.parts.clear()
                self.parts[part] = out
        return out

    def __missing__(self, word: str) -> bytes:
        if len(word) > CACHE_CHARS:
            return self.encode(word)
        if _PLAIN.fullmatch(word) and "<|" not in word:
            out = b"".join(map(self.part, _PARTS.findall(word.lower())))
        else:
            out = self.encode(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = out
        return out

    def of_text(self, text: str) -> bytes:
        if any(c in text for c in _NOT_SPACE):
            return self.encode(text)
        return b"".join(map(self.__getitem__, text.split()))


@lru_cache(maxsize=1)
def tokenizer_of(path: str | None):
    """The tokenizer of this worker process."""
    from tokenizers import Tokenizer
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("word_bpe_49k.json")
    return Tokenizer.from_file(path)


def word_ids(path: str | None) -> WordIds:
    """A task's word ids. Their cache ends with the task: kept in the worker, it would take memory from the stages that use it next."""
    return WordIds(tokenizer_of(path))


def cut(ids: bytes, max_tokens: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc) of a document's ids."""
    step = 4 * max_tokens
    return [(i, i * max_tokens, len(part := ids[at:at + step]) // 4, zlib.crc32(part))
            for i, at in enumerate(range(0, len(ids), step))]


def document_pieces(docs: DataFrame, tokenizer_path: str | None = None, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece. The tokenizer file is read on each executor."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer_path)
        for batch in batches:
            yield arrow_rows([(doc_id, *x) for doc_id, text in texts_of(batch, "doc_id", "text")
                              for x in cut(words.of_text(text or "") + END, max_tokens)], PIECES)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(pieces, PIECES_DDL)


class Bins:
    """Sequences under construction: lists of (length, item)."""

    def __init__(self, capacity: int):
        self.capacity, self.items, self.fill = capacity, [], []

    def add(self, at: int, piece: tuple[int, int]) -> None:
        self.items[at].append(piece)
        self.fill[at] += piece[0]

    def take(self, at: int, piece: tuple[int, int]) -> None:
        self.items[at].remove(piece)
        self.fill[at] -= piece[0]


def best_fit(lengths: list[int], capacity: int) -> Bins:
    bins = Bins(capacity)
    rooms: list[int] = []            # the room sizes that exist, sorted
    by_room: dict[int, list[int]] = {}
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[item]
        k = bisect_left(rooms, n)
        if k < len(rooms):
            room = rooms[k]
            at = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[k]
        else:
            room, at = capacity, len(bins.items)
            bins.items.append([])
            bins.fill.append(0)
        bins.add(at, (n, item))
        if left := room - n:
            if left not in by_room:
                by_room[left] = []
                insort(rooms, left)
            by_room[left].append(at)
    return bins


class Donors:
    """The pieces of underfull sequences by length, each with the sequence it lies in."""

    def __init__(self, bins: Bins, among: list[int]):
        self.at: dict[int, dict[tuple[int, int], int]] = {}
        self.sizes: list[int] = []
        for b in among:
            for piece in bins.items[b]:
                self.put(piece, b)

    def put(self, piece: tuple[int, int], b: int) -> None:
        if piece[0] not in self.at:
            self.at[piece[0]] = {}
            insort(self.sizes, piece[0])
        self.at[piece[0]][piece] = b

    def drop(self, piece: tuple[int, int]) -> None:
        held = self.at[piece[0]]
        del held[piece]
        if not held:
            del self.at[piece[0]]
            self.sizes.pop(bisect_left(self.sizes, piece[0]))

    def largest(self, most: int, more_than: int, fills: list[int], fill: int, besides=None):
        """A piece with more_than < length <= most, the longest first, from a sequence no fuller than ``fill``."""
        k = bisect_left(self.sizes, most + 1) - 1
        while k >= 0 and self.sizes[k] > more_than:
            for piece, b in self.at[self.sizes[k]].items():
                if fills[b] <= fill and piece != besides:
                    return piece, b
            k -= 1
        return None


def best_step(bins: Bins, donors: Donors, b: int):
    """(piece to give away or None, [(piece, its sequence)]) that fills sequence b most, or None."""
    cap, fills, fill = bins.capacity, bins.fill, bins.fill[b]
    room = cap - fill
    if found := donors.largest(room, 0, fills, fill):
        return None, [found]                                       # a move
    gain, step = 0, None
    for mine in sorted(set(bins.items[b])):
        n = mine[0]
        if (found := donors.largest(n + room, n + gain, fills, fill)):
            gain, step = found[0][0] - n, (mine, [found])          # one for one
        first = donors.largest(n + room - 1, n // 2, fills, fill)
        second = first and donors.largest(n + room - first[0][0], max(n + gain - first[0][0], 0), fills, fill, first[0])
        if second:                                                 # two for one
            source = first[1]
            back = first[0][0] + (second[0][0] if second[1] == source else 0)
            if fills[source] - back + n <= cap:
                gain, step = first[0][0] + second[0][0] - n, (mine, [first, second])
        if gain == room:
            break
    return step


def local_search(bins: Bins, rounds: int = ROUNDS) -> None:
    """Fill up the fuller sequences from the emptier ones until nothing moves (or for ``rounds`` passes)."""
    for _ in range(rounds):
        under = sorted((b for b in range(len(bins.items)) if 0 < bins.fill[b] < bins.capacity),
                       key=lambda b: (-bins.fill[b], b))
        donors, moved = Donors(bins, under), False
        for b in under:
            for piece in bins.items[b]:
                donors.drop(piece)      # from here on only emptier sequences give
            while 0 < bins.fill[b] < bins.capacity and (step := best_step(bins, donors, b)):
                mine, theirs = step
                for piece, source in theirs:
                    donors.drop(piece)
                    bins.take(source, piece)
                    bins.add(b, piece)
                if mine:
                    bins.take(b, mine)
                    bins.add(theirs[0][1], mine)
                    donors.put(mine, theirs[0][1])
                moved = True
        if not moved:
            return


def pack_lengths(lengths: list[int], capacity: int = MAX_TOKENS, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """(bin, offset) of each length."""
    bins = best_fit(lengths, capacity)
    local_search(bins, rounds)
    out, number = [(0, 0)] * len(lengths), 0
    for items in bins.items:
        at = 0
        for length, item in sorted(items, key=lambda x: x[1]):
            out[item] = (number, at)
            at += length
        number += bool(items)
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, max_tokens: int = MAX_TOKENS,
                   group_pieces: int = GROUP_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    # numbered as they are written, so that equal pieces spread over the groups as well
    numbered = document_pieces(docs, tokenizer_path, max_tokens).withColumn("row_no", F.monotonically_increasing_id())
    pieces = materialize(numbered, "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    key = F.pmod(F.xxhash64("row_no"), F.lit(groups)).cast("int")

    def packed(group: pa.Table) -> pa.Table:
        group = group.sort_by([(c, "ascending") for c in ("length", "doc_id", "piece", "ids_crc32")])
        places = pack_lengths(group.column("length").to_pylist(), max_tokens, rounds)
        group = group.append_column("bin", pa.array([b for b, _ in places], pa.int32()))
        return group.append_column("offset", pa.array([o for _, o in places], pa.int64()))

    # full-length pieces need no search: sequences with even numbers; the others: odd numbers of (group, bin)
    whole = pieces.where(F.col("length") == max_tokens).select(
        "*", (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    rest = pieces.where(F.col("length") < max_tokens).withColumn("group_id", key).drop("row_no") \
        .groupBy("group_id").applyInArrow(packed, PACKED_DDL) \
        .withColumn("sequence_id", (F.col("group_id").cast("bigint") * (1 << 31) + F.col("bin")) * 2 + 1)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return whole.select(columns).unionByName(rest.select(columns))
