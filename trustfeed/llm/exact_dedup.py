"""Exact de-duplication by composable polynomial fingerprints.

A text is normalised (each run of ASCII white space becomes one space; null counts as empty), encoded as UTF-8 and cut into
chunks. Each chunk gets a polynomial hash modulo two primes; hashes of neighbouring chunks combine by length-shifted
arithmetic, H(ab) = H(a) * B^len(b) + H(b) (mod p), so the chunks of a long text are hashed by different tasks and their
hashes put together per row; a text of one chunk is hashed where it is read.

Rows with equal (fingerprint, length) are candidates. Their texts are then compared chunk by chunk: per (fingerprint,
chunk number) the smallest and the largest chunk must be equal, an aggregate that Spark computes in part before it shuffles, so
a group with a third of all rows costs no more than its distinct chunks. A group in which a chunk differs (a
collision) is split by the SHA-256 of its texts.

Edge cases: null and empty texts are equal to each other; a text of white space only is one space; the row with the smallest
doc_id stays, null doc_ids come last; of repeated rows (same doc_id, same text) one stays; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustfeed.llm.common import SPACE, arrow_rows, maybe_in, text_or_empty, texts_of
from trustfeed.session import materialize

CHUNK = 1 << 16
PRIMES = (2147483647, 2147483629)
BASES = (1315423911, 1640531513)

_SPACES = re.compile(SPACE)


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """base^(n-1), ..., base, 1 modulo prime."""
    out = np.ones(n, dtype=np.uint64)
    done = 1
    while done < n:  # doubling: the second half is the first, shifted by base^done
        step = min(done, n - done)
        out[done:done + step] = out[:step] * np.uint64(pow(base, done, prime)) % np.uint64(prime)
        done += step
    return out[::-1].copy()


_TABLES = [_powers(b, p, CHUNK) for b, p in zip(BASES, PRIMES)]


def chunk_hash(chunk: bytes) -> tuple[int, int, int]:
    """(hash modulo the first prime, modulo the second, length); bytes count from 1, so leading zeros show."""
    values = np.frombuffer(chunk, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    first, second = (int((values * t[CHUNK - len(values):]).sum() % np.uint64(p)) for t, p in zip(_TABLES, PRIMES))
    return first, second, len(chunk)


def combine(a: tuple[int, int, int], b: tuple[int, int, int]) -> tuple[int, int, int]:
    """The fingerprint of the concatenation of two texts with fingerprints a and b."""
    return (*((x * pow(base, b[2], p) + y) % p for x, y, base, p in zip(a, b, BASES, PRIMES)), a[2] + b[2])


def chunks_of(body: bytes) -> Iterator[bytes]:
    return (body[i:i + CHUNK] for i in range(0, len(body), CHUNK))


def fingerprint(body: bytes) -> tuple[int, int, int]:
    out = (0, 0, 0)
    for chunk in chunks_of(body):
        out = combine(out, chunk_hash(chunk))
    return out


def normalised(text: str | None) -> bytes:
    return _SPACES.sub(" ", text or "").encode("utf-8", "surrogatepass")


_FIRST = pa.schema([("row_no", pa.int64()), ("doc_id", pa.int64()), ("h", pa.int64()), ("fp", pa.int64()), ("n_bytes", pa.int64()),
                    ("text_sha256", pa.string()), ("at", pa.int32()), ("chunk", pa.binary())])
_HASHES = pa.schema([("row_no", pa.int64()), ("at", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])
_WHOLE = pa.schema([("row_no", pa.int64()), ("fp", pa.int64())])
_CHUNKS = pa.schema([("fp", pa.int64()), ("n_bytes", pa.int64()), ("at", pa.int32()), ("chunk", pa.binary())])
MOST_BYTES = 4 << 20        # of chunks in one record batch


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _joined(a: int, b: int) -> int:
    return (a << 31) | b


def _in_batches(rows, schema: pa.Schema, size_of):
    """Record batches of some megabytes each."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if size >= MOST_BYTES:
            yield arrow_rows(held, schema)
            held, size = [], 0
    if held:
        yield arrow_rows(held, schema)


def _first_pass(batches):
    """A row per text; one of several chunks has no fingerprint yet, its chunks follow as rows of their own."""
    def rows():
        for batch in batches:
            for row_no, doc_id, h, text in texts_of(batch, "row_no", "doc_id", "h", "text"):
                body = normalised(text)
                sha = hashlib.sha256(body).hexdigest()
                if len(body) <= CHUNK:
                    a, b, n = fingerprint(body)
                    yield row_no, doc_id, h, _joined(a, b), n, sha, None, None
                    continue
                yield row_no, doc_id, h, None, len(body), sha, None, None
                for at, chunk in enumerate(chunks_of(body)):
                    yield row_no, None, None, None, None, None, at, chunk
    return _in_batches(rows(), _FIRST, lambda row: 200 + len(row[7] or b""))


def _hash_chunks(batches):
    for batch in batches:
        yield arrow_rows([(r, at, *chunk_hash(c)) for r, at, c in texts_of(batch, "row_no", "at", "chunk")], _HASHES)


def _combine_row(group: pa.Table) -> pa.Table:
    """The chunk hashes of one text, combined in the order of the chunks."""
    out = (0, 0, 0)
    for part in zip(*(group.sort_by("at").column(c).to_pylist() for c in ("a", "b", "n"))):
        out = combine(out, part)
    return pa.Table.from_batches([arrow_rows([(group.column("row_no")[0].as_py(), _joined(*out[:2]))], _WHOLE)])


def fingerprints(docs: DataFrame) -> DataFrame:
    """row_no, doc_id, h (a hash of the text as it stands), fp, n_bytes, text_sha256 of each row, written once."""
    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.xxhash64(text_or_empty()).alias("h"), "text")
    first = materialize(rows.mapInArrow(_first_pass, _ddl(_FIRST)), "fingerprints-first")
    chunks = first.where(F.col("chunk").isNotNull()).select("row_no", "at", "chunk").repartition("row_no", "at")
    whole = chunks.mapInArrow(_hash_chunks, _ddl(_HASHES)).groupBy("row_no").applyInArrow(_combine_row, _ddl(_WHOLE))
    whole = materialize(whole.withColumnRenamed("row_no", "long_no").withColumnRenamed("fp", "long_fp"), "fingerprints-long")
    columns = ["row_no", "doc_id", "h", "fp", "n_bytes", "text_sha256"]
    first = first.where(F.col("at").isNull())
    long = first.where(F.col("fp").isNull()).join(whole, F.col("row_no") == F.col("long_no")).withColumn("fp", F.col("long_fp"))
    return materialize(first.where(F.col("fp").isNotNull()).select(columns).unionByName(long.select(columns)), "fingerprints")


def _chunks(batches):
    """The chunks of each text."""
    def rows():
        for batch in batches:
            for fp, n, text in texts_of(batch, "fp", "n_bytes", "text"):
                for at, chunk in enumerate(chunks_of(normalised(text))):
                    yield fp, n, at, chunk
    return _in_batches(rows(), _CHUNKS, lambda row: 50 + len(row[3]))


def differing_groups(docs: DataFrame, prints: DataFrame) -> DataFrame:
    """(fp, n_bytes) of groups with equal fingerprints whose texts differ in some chunk.

    Only texts of such groups are shuffled, each different one once per task: copies add nothing.
    """
    many = prints.groupBy("fp", "n_bytes").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = prints.select("h", "fp", "n_bytes").distinct().join(many, ["fp", "n_bytes"], "left_semi") \
        .withColumnRenamed("h", "h_")
    members = materialize(members, "dedup-members")
    texts = maybe_in(docs.select(F.xxhash64(text_or_empty()).alias("h"), text_or_empty().alias("text")), "h", members.select("h_"))
    texts = texts.distinct().join(members, F.col("h") == F.col("h_")).select("fp", "n_bytes", "text")
    chunks = texts.mapInArrow(_chunks, _ddl(_CHUNKS))
    same = chunks.groupBy("fp", "n_bytes", "at").agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi"))
    return same.where("lo <> hi").select("fp", "n_bytes").distinct()


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    prints = fingerprints(docs)
    split = materialize(differing_groups(docs, prints), "collisions").withColumn("split", F.lit(True))
    rows = prints.join(split, ["fp", "n_bytes"], "left") \
        .withColumn("part", F.when(F.col("split"), F.col("text_sha256")).otherwise(F.lit("")))
    key = ["fp", "n_bytes", "part"]
    # null doc_ids last; of rows with the same doc_id the first one
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_no")).alias("first")
    groups = materialize(rows.groupBy(*key).agg(first, F.count(F.lit(1)).alias("group_size")), "dedup-groups")
    return rows.join(groups, key).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), F.col("group_size").cast("bigint").alias("group_size"),
        (F.col("row_no") == F.col("first.row_no")).alias("kept"), "text_sha256")
