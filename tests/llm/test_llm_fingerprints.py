"""Fingerprints: likeness against the exact similarity, the draws' distribution, neighbours against a plain pass."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from conftest import SF_SMALL
from frames import ROWS, documents, empty
from trustfeed.llm.common import table
from trustfeed.llm.weighted_sampling import (SAMPLES, STRETCH, Draws, Terms, edited, fingerprint, fingerprint_pair, fingerprints,
                                           likeness, neighbour_fingerprints)

DRAWS, TERMS = Draws(SAMPLES), Terms()


def similarity(a, b):
    a, b = Counter(a.tolist()), Counter(b.tolist())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_likeness_is_the_generalised_jaccard_similarity():
    draws, rng, errors = Draws(512), np.random.default_rng(3), []
    for _ in range(60):
        terms = np.unique(rng.integers(1, 2 ** 63, 50).astype(np.uint64))
        a, b = (np.repeat(terms, rng.integers(0, 2 ** rng.integers(1, 6), 50)) for _ in range(2))
        x, y = fingerprint_pair(draws, a, b)
        assert x == fingerprint(draws, a) and y == fingerprint(draws, b)
        errors.append(likeness(x, y) - similarity(a, b))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.03


def test_a_term_is_drawn_in_proportion_to_its_weight():
    draws = Draws(4096)
    terms = np.sort(np.random.default_rng(5).integers(1, 2 ** 63, 4).astype(np.uint64))
    weights = np.array([1, 2, 3, 10])
    _, drawn, _ = draws.least(terms, weights)
    shares = np.array([(drawn == t).mean() for t in terms])
    assert np.abs(shares - weights / weights.sum()).max() < 0.03


def test_words_are_cut_at_ascii_white_space_whatever_the_stretch():
    words = ["wörd%d" % (i % 1000) for i in range(30_000)] + ["x" * (2 * STRETCH)] + ["tail"]
    h = TERMS.words(("\t" + " \n".join(words) + " ").encode())
    assert len(h) == len(words) and len(set(h.tolist())) == 1002
    assert h[0] == TERMS.words(b"w\xc3\xb6rd0")[0] and h[-1] == TERMS.words(b"tail")[0] and h[1000] == h[0]
    assert len(TERMS.words(b" \n")) == 0 and len(TERMS.words("a\xa0b".encode())) == 1


def check_neighbours(got, rows):
    """``rows`` in order; each against its edited text and the next row, made one at a time."""
    assert len(got) == len(rows)
    for (doc_id, text), (_, following), r in zip(rows, [*rows[1:], rows[0]], got):
        other = edited(text, following)
        a, b, c = (fingerprint(DRAWS, TERMS.of(t)) for t in (text, other, following))
        assert (r["doc_id"], r["n_chars"], r["edited_sha256"]) == (doc_id, len(text), hashlib.sha256(other.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (a.hex(), b.hex())
        assert (r["near_edited"], r["near_next"]) == (likeness(a, b), likeness(a, c))


@pytest.mark.parametrize("partitions", [1, 3, 400])
def test_neighbours_match_a_plain_pass(spark, partitions):
    docs = table(spark, SF_SMALL, "documents")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(neighbour_fingerprints(docs.repartition(3)).collect(), key=lambda r: r["doc_id"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    check_neighbours(got, sorted((r["doc_id"], r["text"] or "") for r in docs.collect()))
    errors = [r["near_edited"] for r in got if r["n_chars"] > 400]
    assert np.mean(errors) > 0.25 and np.mean([r["near_next"] for r in got if r["n_chars"] > 400]) < 0.05
    by_id = {r["doc_id"]: r["fingerprint"] for r in fingerprints(docs).collect()}
    assert all(by_id[r["doc_id"]] == r["fingerprint"] for r in got)


def test_edges(spark):
    docs = documents(spark)
    got = neighbour_fingerprints(docs).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in ROWS)
    by_text = {}
    for r in got:
        if r["doc_id"] is not None:
            text = [x[1] or "" for x in ROWS if x[0] == r["doc_id"]][0]
            assert by_text.setdefault(text, r["fingerprint"]) == r["fingerprint"] and r["n_chars"] == len(text)
    empties = [r for r in got if r["doc_id"] in (3, 4, 5)]
    assert {r["fingerprint"] for r in empties} == {""}
    assert [r["near_next"] for r in got if r["doc_id"] in (3, 4)] == [1.0, 1.0]
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))
    one = neighbour_fingerprints(docs.where("doc_id = 1")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert neighbour_fingerprints(empty(spark)).collect() == []


def test_a_third_of_the_rows_with_one_id_is_spread(spark):
    rows = [(None if i % 3 == 0 else i, f"text number {i} with words {i * 7} and {i * 11}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = neighbour_fingerprints(docs).collect()
        sizes = docs.selectExpr("doc_id", "xxhash64(text) as tie").repartitionByRange("doc_id", "tie") \
            .selectExpr("spark_partition_id() as p").groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    assert max(r["count"] for r in sizes) < 700
