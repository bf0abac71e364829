"""Near-duplicate classes by ProbMinHash, banding and verification.

A text's shingles are its runs of five words (lower case; a shorter text is one shingle), weighted by 1 + ln of their
number. Every shingle sends arrivals of a Poisson process whose rate is its weight, each to a register that a hash draws;
a register keeps the shingle that arrived first. A shingle stops as soon as its next arrival comes later than the last of the
document's registers, so most send only one or two. Two texts agree in a register with their probability
Jaccard similarity. Registers are joined to bands, and texts that agree in a band are candidates. A text with repeated shingles
sends a second set of arrivals in which every shingle weighs 1; there two texts agree with the plain Jaccard similarity of their
sets, by which links are defined, and its bands join the others (a text without repeats has the same registers both
ways). So a block that one of two copies repeats many times costs no link.

Texts with the same words are one node from the start. In each bucket every node is compared with one centre (the node that
shares buckets with most others, so the text that near copies were made from, if there is one), which links a large
group with one comparison per member. Then, in buckets whose nodes are still in different classes, pairs across classes are
compared. Most such pairs are ruled out beforehand, without being made: a node
that isn't similar to the centre is similar to another node of about the centre's size only if the two have shingles in common which the
centre hasn't. Pairs are therefore met in the rarest shingles beside their centre's, and in their bucket only if both have
enough in common with the centre for a partner of the other's size. Pairs within the bucket's largest class are never
made, nor pairs of which one has too few shingles in common with all nodes of such buckets together. Before shingles are compared, two bits of each register of weight 1 are: pairs that agree in far fewer registers than a
link would (4 standard deviations) end there. A link needs a Jaccard similarity of the shingle sets of ``SIMILAR`` or more,
computed exactly. Classes are the connected components. Nodes go by a 64-bit hash of their words' 128-bit key.

Edge cases: null and empty texts, and texts of white space only, are one class; texts are equal regardless of case and white space; of
repeated rows one stays; null doc_ids come last when the row that stays is chosen; an empty table gives no rows;
further columns are ignored (near_classes) or kept (drop_near_duplicates).
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trustfeed.llm.common import arrow_rows, fresh, maybe_in, texts_of
from trustfeed.session import materialize

WORDS = 5
SIMILAR = 0.8
# A pair whose sets have a similarity of 0.8 misses all bands of weight 1 with probability (1 - 0.8^5)^24 < 0.0001.
BANDS, ROWS = 24, 5
PART = 1 << 20          # bytes of a text hashed at once
SLACK = 1e-6            # against rounding where a bound is met exactly
FLUSH = 400_000         # shingles whose arrivals are drawn at once

_BASE = 0x9E3779B97F4A7C15
_M = (1 << 64) - 1
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n."""
    def series(base):
        steps = np.full(n, base, dtype=np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)
    return series(_BASE), series(pow(_BASE, -1, 1 << 64))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word, in text order, worked out a part of the text at a time."""
    body = text.lower().encode("utf-8", "surrogatepass")
    out, at = [], 0
    while at < len(body):
        end = min(at + PART, len(body))
        while end < len(body) and not _IS_SPACE[body[end]]:
            end += 1
        part = np.frombuffer(body, dtype=np.uint8, count=end - at, offset=at)
        at = end
        solid = np.concatenate(([False], ~_IS_SPACE[part], [False]))
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        first, last = edges[::2], edges[1::2]
        n = 1 << max(12, int(len(part)).bit_length())
        up, down = _powers(n)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], out=sums[1:], dtype=np.uint64)
        out.append(mix((sums[last] - sums[first]) * down[first]))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def shingles(words: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted different shingle hashes, weights)."""
    if not len(words):
        return words, np.zeros(0)
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for k in range(size):
        total = mix(total + words[k:len(words) - size + 1 + k] + np.uint64(k + 1))
    ids, counts = np.unique(total, return_counts=True)
    return ids, 1.0 + np.log(counts)


def prob_minhash(sets: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """One row of registers per set; each holds the shingle that arrived first."""
    owner = np.repeat(np.arange(len(sets)), [len(ids) for ids, _ in sets])
    ids = np.concatenate([ids for ids, _ in sets]) if sets else np.zeros(0, dtype=np.uint64)
    rate = np.concatenate([w for _, w in sets]) if sets else np.zeros(0)
    when = np.full(len(sets) * registers, np.inf)
    first = np.zeros(len(sets) * registers, dtype=np.uint64)
    last = np.full(len(sets), np.inf)
    x, step = np.zeros(len(ids)), 0
    while len(ids):
        draw = mix(ids + np.uint64((2 * step + 1) * _BASE & _M))
        x = x - np.log1p(-(draw >> np.uint64(11)).astype(np.float64) / (1 << 53)) / rate
        live = x < last[owner]          # the others end: all registers have earlier arrivals
        ids, rate, owner, x, draw = ids[live], rate[live], owner[live], x[live], draw[live]
        to = owner * registers + (mix(draw + np.uint64(_BASE)) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(when, to, x)
        won = when[to] == x
        first[to[won]] = ids[won]
        touched = np.unique(owner)
        last[touched] = when.reshape(-1, registers)[touched].max(axis=1)
        step += 1
    return first.reshape(-1, registers)


def band_hashes(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(registers), bands), dtype=np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    parts = registers.reshape(len(registers), bands, rows)
    for k in range(rows):
        out = mix(out * np.uint64(_BASE) + parts[:, :, k])
    return out


SKETCH = ("s1", "s2", "s3", "s4")


def sketch_bits(registers: np.ndarray) -> np.ndarray:
    """Two bits of each of the first 126 registers: their first bits in two integers per row, their second bits in two more."""
    two = mix(registers[:, :126])
    half = (two.shape[1] + 1) // 2
    out = []
    for shift in (0, 1):
        bits = ((two >> np.uint64(shift)) & np.uint64(1)).astype(np.int64)
        out += [(part << np.arange(part.shape[1])).sum(axis=1) for part in (bits[:, :half], bits[:, half:])]
    return np.stack(out, axis=1)


def most_differing(similar: float, registers: int) -> int:
    """Registers whose two bits differ at most in a pair of this similarity, but for 4 standard deviations."""
    m, same = min(registers, 126), (1 + 3 * similar) / 4
    return int(m * (1 - same) + 4 * (m * same * (1 - same)) ** 0.5)


def _differing():
    """Registers in which the sketches s1..s4 and s1_a..s4_a differ."""
    x = [F.col(c).bitwiseXOR(F.col(f"{c}_a")) for c in SKETCH]
    return F.bit_count(x[0].bitwiseOR(x[2])) + F.bit_count(x[1].bitwiseOR(x[3]))


_SIGNED = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("n", pa.int64()),
                     *((c, pa.int64()) for c in SKETCH), ("bands", pa.list_(pa.int64()))])
_SETS = pa.schema([("key", pa.binary()), ("ids", pa.list_(pa.int64()))])
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_RESTS = pa.schema([("centre", pa.int64()), ("node", pa.int64()), ("both", pa.int64()), ("rest", pa.list_(pa.int64()))])


def _key(words: np.ndarray) -> bytes:
    return hashlib.blake2b(words.tobytes(), digest_size=16).digest()


def _signed(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """doc_id, key of the word sequence, number of different shingles, band hashes."""
    def sign(batches):
        for batch in batches:
            held, sets, waiting = [], [], 0

            def flush():
                live = [i for i, (ids, _) in enumerate(sets) if len(ids)]
                plain = prob_minhash([(sets[i][0], np.ones(len(sets[i][0]))) for i in live], bands * rows)
                lists = dict(zip(live, zip(sketch_bits(plain).tolist(), band_hashes(plain, bands, rows).view(np.int64).tolist())))
                repeats = [i for i in live if sets[i][1].max() > 1]
                weighted = prob_minhash([sets[i] for i in repeats], bands * rows)
                for i, more in zip(repeats, band_hashes(weighted, bands, rows).view(np.int64).tolist()):
                    bits, hashes = lists[i]
                    lists[i] = bits, [*hashes, *(set(more) - set(hashes))]
                return arrow_rows([(d, k, n, *s, b) for i, (d, k, n) in enumerate(held)
                                   for s, b in [lists.get(i, ((0,) * len(SKETCH), []))]], _SIGNED)

            for doc_id, text in texts_of(batch, "doc_id", "text"):
                words = word_hashes(text or "")
                ids, weights = shingles(words, size)
                held.append((doc_id, _key(words), len(ids)))
                sets.append((ids, weights))
                waiting += len(ids)
                if waiting >= FLUSH:
                    yield flush()
                    held, sets, waiting = [], [], 0
            if held:
                yield flush()

    return docs.mapInArrow(sign, "doc_id bigint, key binary, n bigint, " + ", ".join(f"{c} bigint" for c in SKETCH) + ", bands array<bigint>")


def _sets_of(docs: DataFrame, size: int) -> DataFrame:
    """key and sorted shingles of (text) rows."""
    def collect(batches):
        for batch in batches:
            held, waiting = [], 0
            for (text,) in texts_of(batch, "text"):
                words = word_hashes(text or "")
                ids, _ = shingles(words, size)
                held.append((_key(words), ids.view(np.int64)))
                waiting += len(ids)
                if waiting >= FLUSH:
                    yield arrow_rows(held, _SETS)
                    held, waiting = [], 0
            if held:
                yield arrow_rows(held, _SETS)
    return docs.select("text").mapInArrow(collect, "key binary, ids array<bigint>")


def _verified(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """The (a, b) pairs whose shingle sets have a Jaccard similarity of ``similar`` or more."""
    def compare(batches):
        for batch in batches:
            lists = [batch.column(batch.schema.get_field_index(c)) for c in ("ids_a", "ids_b")]
            parts = [(x.values.to_numpy(zero_copy_only=False), x.offsets.to_numpy()) for x in lists]
            keep = []
            for i in range(batch.num_rows):
                a, b = (v[o[i]:o[i + 1]] for v, o in parts)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(both >= similar * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in ("a", "b")],
                                             schema=_LINKS).filter(pa.array(keep, pa.bool_()))

    # only the sets that the pairs name are moved
    left = maybe_in(sets, "node", pairs.select("a")).select(F.col("node").alias("a"), F.col("ids").alias("ids_a"))
    right = maybe_in(sets, "node", pairs.select("b")).select(F.col("node").alias("b"), F.col("ids").alias("ids_b"))
    # the members' sets first; the centres' are met last, where their rows can be split
    full = pairs.join(right, "b").join(left, "a").select("a", "b", "ids_a", "ids_b")
    return full.mapInArrow(compare, "a bigint, b bigint")


def _beside_centres(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of (centre, node) pairs: how many shingles both have, and the node's shingles that the centre hasn't."""
    def compare(batches):
        for batch in batches:
            lists = [batch.column(batch.schema.get_field_index(c)) for c in ("ids_c", "ids")]
            parts = [(x.values.to_numpy(zero_copy_only=False), x.offsets.to_numpy()) for x in lists]
            rests = []
            for i in range(batch.num_rows):
                c, x = (v[o[i]:o[i + 1]] for v, o in parts)
                rests.append((len(x), np.setdiff1d(x, c, assume_unique=True)))
            named = [batch.column(batch.schema.get_field_index(c)) for c in ("centre", "node")]
            both = pa.array([n - len(rest) for n, rest in rests], pa.int64())
            yield pa.RecordBatch.from_arrays([*named, both, pa.array([rest for _, rest in rests], _RESTS.field("rest").type)], schema=_RESTS)

    # only the sets that the pairs name are moved
    of_node = maybe_in(sets, "node", pairs.select("node"))
    of_centre = maybe_in(sets, "node", pairs.select("centre")).select(F.col("node").alias("centre"), F.col("ids").alias("ids_c"))
    return pairs.join(of_node, "node").join(of_centre, "centre").select("centre", "node", "ids_c", "ids") \
        .mapInArrow(compare, "centre bigint, node bigint, both bigint, rest array<bigint>")


def _pairs_by_rest(members: DataFrame, rests: DataFrame, similar: float, alike) -> DataFrame:
    """(a, b) of different classes that have a shingle in common which their centre hasn't, and may be similar.

    A node needs ``similar`` * n shingles in common with the other; those beyond the ones it shares with the centre come
    from its rest, so a pair also meets in the rarest of both rests (prefixes that leave out one less than needed).
    """
    per = members.select("centre", "node", "class", "n", *SKETCH).distinct().join(rests, ["centre", "node"]) \
        .withColumns({"m": F.size("rest"), "least": F.greatest(F.lit(1), F.ceil(similar * F.col("n") - F.col("both") - SLACK))})
    per = per.where("m >= least")
    items = per.select("centre", "node", "class", "m", "least", F.explode("rest").alias("id"))
    counts = items.groupBy("centre", "id").agg(F.count(F.lit(1)).alias("rows"), (F.min("class") != F.max("class")).alias("mixed")) \
        .where("rows > 1")
    own = Window.partitionBy("centre", "node")
    # shingles that no other node has come first and are only counted
    place = F.col("m") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("rows", "id"))
    first = items.join(counts, ["centre", "id"]).withColumn("place", place) \
        .where("place <= m - least + 1 and mixed").select("centre", "node", "id")
    kept = ("node", "class", "n", *SKETCH, "both", "m")
    first = materialize(first.join(per.select("centre", *kept), ["centre", "node"]).select("centre", "id", *kept), "near-rarest")
    other = first.select("centre", "id", *[F.col(c).alias(f"{c}_a") for c in kept])
    room = (F.least("both_a", "both") + F.least("m_a", "m")) * (1 + similar) >= similar * (F.col("n_a") + F.col("n")) - SLACK
    met = first.join(other, ["centre", "id"]).where((F.col("node_a") < F.col("node")) & (F.col("class_a") != F.col("class")) & room & alike)
    return met.select(F.col("node_a").alias("a"), F.col("node").alias("b"))


def _node_sets(texts: DataFrame, nodes: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """node and shingles of the wanted nodes, from one document of each."""
    reps = nodes.select("node", "rep").join(wanted, "node", "left_semi").select("rep").where("rep is not null").distinct()
    reps = materialize(reps, "near-reps")
    some = maybe_in(texts.withColumn("h", F.xxhash64("doc_id")), "h", reps.select(F.xxhash64("rep")))
    found = some.join(reps, F.col("doc_id") == F.col("rep"), "left_semi").drop("h").unionByName(texts.where("doc_id is null"))
    sets = _sets_of(found, size).withColumn("node", F.xxhash64("key"))
    return materialize(sets.groupBy("node").agg(F.first("ids").alias("ids")), "near-sets")


def _shared_shingles(sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """Of (node, n) rows: node and at most how many of its n shingles stand in another wanted node, too.

    Shingles go by 32 bits of their hash, and a few sets beside the wanted ones are read with them; both only raise the number.
    The sets stay where they are, only their shingles are dealt out.
    """
    ids = maybe_in(sets, "node", wanted.select("node")).select("node", "ids")
    each = ids.select("node", F.explode("ids").alias("id")).select("node", F.shiftright("id", 32).cast("int").alias("id"))
    alone = each.groupBy("id").agg(F.min("node").alias("node"), F.max("node").alias("hi")).where("node = hi") \
        .groupBy("node").agg(F.count(F.lit(1)).alias("alone"))
    return wanted.join(alone, "node", "left").select("node", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("common"))


def connected(links: DataFrame) -> DataFrame:
    """(node, class): the connected components of (a, b) links, named by their smallest node."""
    both = materialize(links.union(links.select("b", "a")).distinct().toDF("node", "other"), "links")
    classes = materialize(both.groupBy("node").agg(F.min("other").alias("class"))
                          .select("node", F.least("node", "class").alias("class")), "classes")
    while True:
        named = classes.select(F.col("node").alias("other"), F.col("class").alias("theirs"))
        near = both.join(named, "other").groupBy("node").agg(F.min("theirs").alias("near"))
        step = classes.join(near, "node").select("node", F.col("class").alias("old"), F.least("class", "near").alias("class"))
        jump = classes.select(F.col("node").alias("class"), F.col("class").alias("further"))
        step = step.join(jump, "class").select("node", "old", F.least("class", "further").alias("class"))
        after = materialize(step, "classes")
        if after.where("old <> class").isEmpty():
            return after.select("node", "class")
        classes = after.select("node", "class")


def near_classes(docs: DataFrame, similar: float = SIMILAR, size: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of the class), class_size, kept."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    signed = materialize(_signed(texts, size, bands, rows).withColumn("node", F.xxhash64("key")), "near-signed")
    nodes = materialize(signed.groupBy("node").agg(
        F.min("doc_id").alias("rep"), *[F.first(c).alias(c) for c in ("n", *SKETCH, "bands")]), "near-nodes")
    sketch = ("node", "n", *SKETCH)
    placed = nodes.select(*sketch, F.explode("bands").alias("bucket"))
    # only buckets with several nodes go on
    counted = nodes.select(F.explode("bands").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("in_bucket")) \
        .where("in_bucket > 1")
    counted = materialize(counted, "near-buckets")
    shared = materialize(maybe_in(placed, "bucket", counted.select("bucket")).join(counted, "bucket"), "near-shared")
    near = materialize(shared.groupBy("node").agg(F.sum("in_bucket").alias("near")), "near-neighbours")
    centre = F.max(F.struct("near", *sketch)).alias("c")
    centres = materialize(shared.join(near, "node").groupBy("bucket").agg(centre)
                          .select("bucket", *[F.col(f"c.{x}").alias(f"{x}_a") for x in sketch]), "near-centres")
    far = most_differing(similar, bands * rows)
    alike = (F.least("n_a", "n") >= similar * F.greatest("n_a", "n") - SLACK) & (_differing() <= far)
    star = shared.join(centres, "bucket").where((F.col("node") != F.col("node_a")) & alike)
    star = materialize(star.select(F.col("node_a").alias("a"), F.col("node").alias("b")).distinct(), "near-star")
    sets = _node_sets(texts, nodes, near.select("node"), size)
    links = materialize(_verified(star, sets, similar), "near-links")
    classes = connected(links)
    # buckets whose nodes are in different classes: pairs of a node outside the bucket's largest class with others
    members = shared.join(classes, "node", "left").select("bucket", *sketch, F.coalesce("class", "node").alias("class"))
    counts = members.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("rows"))
    mixed = counts.groupBy("bucket").agg(F.max(F.struct("rows", "class")).alias("m"), F.count(F.lit(1)).alias("classes")) \
        .where("classes > 1").select("bucket", F.col("m.class").alias("home")) \
        .join(centres.select("bucket", F.col("node_a").alias("centre")), "bucket")
    members = materialize(members.join(mixed, "bucket"), "near-mixed")
    # a pair has no more shingles in common than either node has in common with any other node of these buckets
    members = members.join(_shared_shingles(sets, members.select("node", "n").distinct()), "node") \
        .where(F.col("common") >= similar * F.col("n") - SLACK)
    members = materialize(members, "near-mixed")
    # without a common shingle beside the centre's, a pair has no more in common than either has with the centre, which bounds the other's size
    beside = materialize(members.select("centre", "node").distinct(), "near-beside")
    rests = materialize(_beside_centres(beside, sets), "near-rests")
    by_rest = _pairs_by_rest(members, rests, similar, alike)
    members = members.join(rests.select("centre", "node", "both"), ["centre", "node"]) \
        .withColumn("largest", F.col("both") * (1 + similar) / similar - F.col("n") + SLACK)
    fits = (F.col("n") <= F.col("largest_a")) & (F.col("n_a") <= F.col("largest"))
    sketch = (*sketch, "common", "largest")
    enough = F.least("common_a", "common") * (1 + similar) >= similar * (F.col("n_a") + F.col("n")) - SLACK
    outside = members.where("class <> home").select("bucket", F.col("class").alias("class_a"),
                                                    *[F.col(x).alias(f"{x}_a") for x in sketch])
    # each pair once: two nodes outside in one order
    once = (F.col("class") != F.col("class_a")) & ((F.col("class") == F.col("home")) | (F.col("node") < F.col("node_a")))
    across = outside.join(members, (outside["bucket"] == members["bucket"]) & once & enough & fits & alike)
    pairs = across.select(F.least("node", "node_a").alias("a"), F.greatest("node", "node_a").alias("b")) \
        .union(by_rest).distinct()
    done = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = materialize(pairs.join(done, ["a", "b"], "left_anti"), "near-across")
    more = materialize(_verified(pairs, sets, similar), "near-links")
    if not more.isEmpty():
        classes = connected(links.unionByName(more))
    named = signed.select("doc_id", "key", "node").join(classes, "node", "left") \
        .select("doc_id", "key", F.coalesce("class", "node").alias("class"))
    named = materialize(named, "near-named")
    # written, so that a very large class's rows can be split in the join
    sizes = materialize(named.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")), "near-sizes")
    again = Window.partitionBy("class", "doc_id").orderBy("key")
    kept = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("again") == 1)
    return named.withColumn("again", F.row_number().over(again)).join(sizes, "class") \
        .select("doc_id", "class_id", "class_size", kept.alias("kept"))


def drop_near_duplicates(docs: DataFrame, similar: float = SIMILAR, size: int = WORDS, bands: int = BANDS,
                         rows: int = ROWS) -> DataFrame:
    """The documents with all their columns, one of each class (the smallest doc_id; of repeated rows the one whose columns' hash is least)."""
    number, ident, at = (fresh(docs, f"_near_{x}") for x in ("number", "ident", "at"))
    # rows are numbered by what they hold: equal rows (same doc_id and text) share a number
    numbered = docs.select("*", F.xxhash64("doc_id", "text").alias(number), F.coalesce("doc_id", F.lit(0)).cast("bigint").alias(ident))
    first = docs.select(F.col("doc_id").cast("bigint").alias("real"), F.xxhash64("doc_id", "text").alias("doc_id"), "text")
    classes = near_classes(first, similar, size, bands, rows).select("doc_id", "class_id")
    names = first.select("real", "doc_id").distinct().join(classes.distinct(), "doc_id")
    stays = names.groupBy("class_id").agg(F.min(F.struct(F.col("real").isNull().alias("none"), "real", "doc_id")).alias("s")) \
        .select(F.col("s.doc_id").alias("stay"), F.coalesce("s.real", F.lit(0)).alias("stay_id"))
    # repeated rows with other extra columns go by a hash of them, so reruns keep the same one
    hashed = [f"`{c.name}`" for c in docs.schema if "map<" not in c.dataType.simpleString()]
    one = Window.partitionBy(number, ident).orderBy(F.xxhash64(*hashed))
    joined = numbered.join(stays, (F.col(number) == F.col("stay")) & (F.col(ident) == F.col("stay_id")))
    return joined.withColumn(at, F.row_number().over(one)).where(F.col(at) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
