"""Runs of words against a plain search for every period."""

import hashlib
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from frames import ROWS, documents, empty
from trustfeed.llm.common import WORD, table
from trustfeed.llm.periodic_runs import find_runs, periodic_runs


def plain_runs(w):
    """All (start, end, period) by trying every period at every place."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            x = w[s:i + q]
            if len(x) >= max(6, 4 * q) and all(any(a != b for a, b in zip(x, x[d:])) for d in range(1, q)):
                out.append((s, i + q, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


@st.composite
def sequences(draw):
    w = draw(st.lists(st.integers(0, 2), max_size=60))
    for _ in range(draw(st.integers(0, 2))):
        block = draw(st.lists(st.integers(0, 3), min_size=1, max_size=9))
        at = draw(st.integers(0, len(w)))
        w = w[:at] + block * draw(st.integers(2, 7)) + block[:draw(st.integers(0, len(block)))] + w[at:]
    return w


@settings(max_examples=300, deadline=None)
@given(sequences())
def test_runs_match_a_plain_search(w):
    assert [tuple(r) for r in find_runs(np.array(w, dtype=np.int64)).tolist()] == plain_runs(w)


def test_long_runs():
    w = np.concatenate((np.arange(100, 3100), np.tile(np.arange(700), 5), np.full(5000, 7)))
    assert find_runs(w).tolist() == [[3000, 6500, 700], [6500, 11500, 1]]


def plain_row(doc_id, text):
    words = re.findall(WORD, text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = [(s, e - s, q) for s, e, q in plain_runs(words)]
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (
        "".join("%d,%d,%d\n" % r for r in runs), " ".join(w for i, w in enumerate(words) if i not in gone))]
    return (doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2], *sha)


def test_query_matches_a_plain_search(spark):
    docs = table(spark, SF_SMALL, "documents")
    want = sorted(plain_row(r["doc_id"], r["text"]) for r in docs.collect() if len(r["text"]) < 4000)
    found = {r["doc_id"]: tuple(r) for r in periodic_runs(docs).collect()}
    assert len(found) == docs.count() and any(r[1] for r in want)
    assert [found[r[0]] for r in want] == want


def test_edges(spark):
    got = [tuple(r) for r in periodic_runs(documents(spark)).collect()]
    assert len(got) == len(ROWS)
    nothing = hashlib.sha256().hexdigest()
    for r in got:
        if r[0] in (3, 4, 5):
            assert r[1:6] == (0, None, None, None, None) and r[6] == r[7] == nothing
    long = [r for r in got if r[0] == 7][0]
    assert long[1:6] == (1, 0, 44_000, 11, 4_000_000)
    short = [r for r in ROWS if r[0] not in (6, 7)]
    assert sorted(r for r in got if r[0] not in (6, 7) and r[0] is not None) == sorted(
        plain_row(r[0], r[1]) for r in short if r[0] is not None)
    assert periodic_runs(empty(spark)).collect() == []
