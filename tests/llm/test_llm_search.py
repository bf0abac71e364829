"""Ranked search: tiles, blocks and strips against the SQL and plain sums; ties, repeats and nulls."""

import numpy as np
import pytest

from conftest import SF_SMALL
from frames import documents, empty
from oracle_harness import compare
from trustfeed.llm.common import table
from trustfeed.llm.lexical_search import EXACT, MOST_IMPACT, ItemTile, exact_strips, lexical_search, terms_of
from trustfeed.llm.queries import ORACLES

ITEMS = "item_id bigint, text string"


def test_small_blocks_and_tiles_give_the_same(spark, duck_small):
    docs, items = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")
    found = lexical_search(docs.repartition(7), items, block_items=15, tile_docs=3, tile_items=4)
    problems, n = compare(found, duck_small, ORACLES["op13_lexical_search"])
    assert not problems and n, problems


def test_terms():
    text = "Don't STOP\x00at É-Æ_ß2 x \U0001F600,ÄÖ"
    assert [t.decode() for t in terms_of(text.encode())] == ["don", "t", "stop", "at", "É", "Æ", "ß2 x", "\U0001F600", "ÄÖ"]


def test_ties_repeats_and_nulls(spark):
    same = [(i, "alpha beta") for i in range(40, 20, -1)] + [(None, "alpha beta"), (3, "alpha beta gamma"), (21, "alpha beta"),
                                                           (1, None), (2, " ")]
    docs = spark.createDataFrame(same, "doc_id bigint, text string").repartition(5)
    items = spark.createDataFrame([(1, "Beta alpha"), (1, "gamma gamma"), (2, None), (None, "GAMMA"), (4, "delta")], ITEMS)
    rows = [tuple(r) for r in lexical_search(docs, items).collect()]
    first = sorted(r for r in rows if r[0] == 1 and r[3] != max(x[3] for x in rows))
    assert [r[2] for r in first] == [21, 21, *range(22, 30)] and [r[1] for r in first] == list(range(1, 11))
    assert len({r[3] for r in first}) == 1
    gamma = [r for r in rows if r[2] == 3]
    assert sorted(r[3] for r in gamma) == [gamma[0][3] and min(r[3] for r in gamma), 2 * min(r[3] for r in gamma)]
    assert {r[0] for r in rows} == {1, None}
    every = lexical_search(docs, items.where("text = 'Beta alpha'"), k=100).orderBy("rank").collect()
    assert len(every) == 23 and every[-1]["doc_id"] == 3 and every[-2]["doc_id"] is None


def test_products_stay_exact():
    weights = np.array([20_000, 20_000, 1, 0], dtype=np.int64)
    counts = np.array([[1_000_000.0, 2.0], [3.0, 400_000.0], [1.0, 0.0], [5.0, 5.0]])
    strips = list(exact_strips(counts, weights))
    assert sum(len(c) for _, c in strips) > 4
    for at, part in strips:
        assert (part.max(axis=1) * np.maximum(weights[at], 1) * MOST_IMPACT).sum() < EXACT
    tile = ItemTile([0, 1], [{0: 1_000_000, 1: 3, 2: 1, 3: 5}, {0: 2, 1: 400_000, 3: 5}], weights)
    impacts = np.array([999_999 * 20_000, 999_998 * 20_000, 7], dtype=np.int64)
    got = tile.scores(np.zeros(3, dtype=np.int64), np.array([0, 1, 2]), impacts.astype(np.float64), 1)
    assert got.tolist() == [[1_000_000 * 999_999 * 20_000 + 3 * 999_998 * 20_000 + 7, 2 * 999_999 * 20_000 + 400_000 * 999_998 * 20_000]]


@pytest.mark.parametrize("which", ["docs", "items"])
def test_edges(spark, which):
    items = spark.createDataFrame([(1, "words the text long"), (2, "")], ITEMS).selectExpr("*", "1 as item", "2 as rank", "3 as doc_id")
    docs = documents(spark)
    rows = lexical_search(docs, items).collect()
    assert {r["item_id"] for r in rows} == {1} and [r["rank"] for r in sorted(rows, key=lambda r: r["rank"])] == list(range(1, len(rows) + 1))
    assert None in {r["doc_id"] for r in rows}
    none = lexical_search(empty(spark), items) if which == "docs" else lexical_search(docs, items.where("item_id < 0"))
    assert none.collect() == [] and none.columns == ["item_id", "rank", "doc_id", "score"]
