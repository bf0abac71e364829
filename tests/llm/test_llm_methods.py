"""The operators against plain versions, exact round trips and held-out labels."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from frames import documents
from trustfeed.llm import exact_dedup as exact
from trustfeed.llm import html_blocks, importance, near_dedup, packing, sharding, toxicity
from trustfeed.llm.line_templates import dedup_lines, drop_recurring
from trustfeed.llm.mixing import mixed_documents
from trustfeed.llm.queries import QUERIES


def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


# ------------------------------------------------------------------ 1
def shingle_set(text, size=5):
    words = text.lower().split()
    k = min(size, len(words))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute_classes(by_id, similar=0.8):
    sets = {i: shingle_set(t) for i, t in by_id.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    order = sorted(sets)
    for n, i in enumerate(order):
        for j in order[:n]:
            both = len(sets[i] & sets[j])
            if both >= similar * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in sets}


def test_near_classes_equal_brute_force(spark):
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op1_near_classes"](spark, SF_SMALL).collect()}
    assert got == brute_classes(texts(spark))


def test_near_classes_of_a_large_group_and_a_chain(spark):
    random.seed(5)
    base = [f"w{random.randint(0, 10 ** 6)}" for _ in range(200)]
    rows = []
    for i in range(300):                       # near copies of one text, each with one other word
        words = list(base)
        words[i % 200] = f"x{i}"
        rows.append((i, " ".join(words)))
    chain = [f"c{i}" for i in range(120)]
    for i in range(6):                         # neighbours are alike, the ends are not
        rows.append((1000 + i, " ".join(chain[5 * i:5 * i + 95])))
    rows += [(2000 + i, " ".join(f"u{i}_{k}" for k in range(50))) for i in range(20)]
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == brute_classes(dict(rows))


def test_near_classes_of_texts_far_from_their_centre(spark):
    """Texts too far from the text they were made from, of several sizes; some are alike by the changes they share."""
    random.seed(11)
    base = [f"b{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 160):
        words = list(base)
        for place in random.sample(range(0, 200, 5), random.choice([5, 8, 9])):
            words[place] = f"x{i}_{place}"
        rows.append((i, " ".join(words[:random.choice([200, 200, 185, 170])])))
        if i % 8 == 0:
            words[random.randrange(3, 160)] = f"y{i}"
            rows.append((1000 + i, " ".join(words[:190])))
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    want = brute_classes(dict(rows))
    assert got == want
    assert any(i > 1000 and want[i] == i - 1000 for i in want) and len(set(want.values())) > 20


def test_near_classes_of_copies_with_a_block_that_repeats(spark):
    """The sets' similarity is 0.8 or more, the weighted one far less."""
    random.seed(3)
    rows = []
    for i in range(150):
        words = [f"w{i}_{k}" for k in range(200)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words + [f"x{i}_{k}" for k in range(35)] * 20))]
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    want = brute_classes(dict(rows))
    assert sum(want[2 * i + 1] == 2 * i for i in range(150)) == 150
    assert sum(got[2 * i + 1] == 2 * i for i in range(150)) >= 149


def test_near_duplicates_keep_the_same_repeated_row(spark):
    rows = [(1, "a b c d e f", x) for x in range(40)]
    kept = {near_dedup.drop_near_duplicates(spark.createDataFrame(random.sample(rows, 40), "doc_id bigint, text string, x int")
                                            .repartition(n)).collect()[0]["x"] for n in (1, 3, 7)}
    assert len(kept) == 1


def test_prob_minhash_estimates_probability_jaccard():
    rng = np.random.default_rng(1)
    ids = near_dedup.mix(np.arange(60, dtype=np.uint64))
    a, b = rng.uniform(0.5, 3, 50), rng.uniform(0.5, 3, 50)
    wa, wb = dict(zip(ids[:50].tolist(), a)), dict(zip(ids[10:].tolist(), b))
    want = 0.0
    for x in wa.keys() & wb.keys():
        want += 1 / sum(max(wa.get(y, 0) / wa[x], wb.get(y, 0) / wb[x]) for y in wa.keys() | wb.keys())
    got = near_dedup.prob_minhash([(ids[:50], a), (ids[10:], b)], 20_000)
    assert (got[0] == got[1]).mean() == pytest.approx(want, abs=0.015)


def test_word_hashes_do_not_depend_on_the_parts(monkeypatch):
    text = "  ".join(f"word{i}é" for i in range(5000)) + "\n"
    whole = near_dedup.word_hashes(text)
    monkeypatch.setattr(near_dedup, "PART", 1000)
    assert (near_dedup.word_hashes(text) == whole).all() and len(set(whole.tolist())) == 5000


# ------------------------------------------------------------------ 2
def test_line_templates_generalise_fields_and_keep_one(spark):
    log = "user {} logged in from host {} at the usual hour today"
    body = "This passage of more than a few words stands in several documents as it is and must go from all but one"
    rows = [(1, "own line with its very own words here\n" + log.format("17", "a.example")),
            (2, log.format("99", "b.example") + "\nanother line that nobody else has written so far"),
            (3, body), (4, "first\n" + body + "\nlast"), (5, body + "\nthe end of it"), (6, "same\nsame"), (7, "same\nother")]
    got = {r["doc_id"]: r["text"] for r in dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1] == rows[0][1] and got[2] == "another line that nobody else has written so far"
    assert got[3] == body and got[4] == "first\nlast" and got[5] == "the end of it"
    assert got[6] == "same\nsame" and got[7] == "other"


def test_short_boilerplate_goes_and_chance_stays(spark):
    """Three tokens in 30 of 200 documents go from all but the first; pairs of six words, in about as many, stay."""
    random.seed(3)
    pairs = [f"{a} {b}" for a in ("red", "old", "big", "hot", "dry", "raw") for b in ("hat", "cup", "box", "pen", "map", "jar")]
    rows = [(i, "\n".join([f"document number {i} has a line of its own", *random.sample(pairs, 4),
                           *(["All rights reserved."] if i % 7 == 3 else [])])) for i in range(200)]
    got = {r["doc_id"]: r["text"].split("\n") for r in drop_recurring(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    kept = [i for i, lines in got.items() if "All rights reserved." in lines]
    assert kept == [3]
    assert sum(line in pairs for lines in got.values() for line in lines) == 800


def lines_left(spark, rows):
    """Query and stage have one rule: the texts of both, by document."""
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    query, stage = ({r["doc_id"]: r["text"] for r in f(docs).collect()} for f in (dedup_lines, drop_recurring))
    assert stage == {i: t for i, t in query.items() if t.split() or dict(rows)[i] == t}
    return query


@pytest.mark.parametrize("one,two", [
    ("one two three four apple zebra mint", "one two three four zoo ant moss"),
    ("one two three four zoo ant moss", "one two three four apple zebra mint"),
    ("one two three four apple ant moss", "one two three four zoo zebra mint")])
def test_lines_with_little_in_common_are_no_template(spark, one, two):
    rows = [(1, one), (2, two)]
    assert lines_left(spark, rows) == dict(rows)


def test_short_lines_recur_in_small_tables(spark):
    rows = [(i, f"Document {name} has this line alone among all others\nReleased under the MIT License.\nAll rights reserved.")
            for i, name in enumerate(("alpha", "beta", "gamma"))]
    got = lines_left(spark, rows)
    assert got[0] == rows[0][1] and [got[i] for i in (1, 2)] == [rows[i][1].split("\n")[0] for i in (1, 2)]


def test_short_lines_with_variable_fields(spark):
    names = "".join(random.Random(1).sample("abcdefghijklmnopqrstuvwxyz", 20))
    rows = [(i, f"Page {i} of 39\n{x * 5} writes {x * 4} about {x * 6} and {x * 7}\n{1000 + i}\n2024-01-01") for i, x in enumerate(names)]
    got = lines_left(spark, rows)
    assert got[0] == rows[0][1]
    for i in range(1, 20):
        # numbers alone are no template: a different one stays, the repeated date goes
        assert got[i] == "\n".join(rows[i][1].split("\n")[1:3])


# ------------------------------------------------------------------ 4
PAGES = [
    ("<body><header><h2>Site name</h2></header><nav><a href=x>Home</a></nav><main><h1>A &amp; B</h1><p>One  two\nthree.<p>Four"
     "<aside>Side</aside><form>Name <input></form><div class='share-buttons'>Share</div></main><footer>&copy; x</footer>",
     "A & B\nOne two three.\nFour"),
    ("<article><header><h1>Title</h1></header><p>Text &lt;b&gt; &#233;<b>bo</b>ld</p><div id=comments><p>Reader says</p></div></article>"
     "<article><p>x</p></article>", "Title\nText <b> ébold"),
    ("<div class='cookie-notice'>We use cookies, a lot of them, all of the time</div><div><p>" + "Long text. " * 30 + "</p><p>Short.</p>"
     "<p>" + "More text. " * 20 + "</p></div><ul><li><a href=1>One</a></li><li><a href=2>Two</a></li><li><a href=3>Three</a></li></ul>",
     ("Long text. " * 30).strip() + "\nShort.\n" + ("More text. " * 20).strip()),
    ("<script>var a = '<p>no</p>';</script><style>p {}</style><!-- <p>no</p> --><p title='a > b'>yes 1 < 2</p>", "yes 1 < 2"),
    ("", ""), (None, ""), ("<nav>only a menu</nav>", ""),
]


@pytest.mark.parametrize("page,want", PAGES)
def test_main_text(page, want):
    assert html_blocks.main_text(page) == want


def test_surge_and_dive():
    assert html_blocks.surges([0, 0, 5, 0, 0, 7, 0, 0, 0, 3]) == [(2, 5), (9, 9)]


# ------------------------------------------------------------------ 6
def test_fingerprints_compose():
    random.seed(2)
    body = bytes(random.randrange(256) for _ in range(200_001))
    whole = exact.fingerprint(body)
    parts = [body[:7], body[7:100], body[100:65_000], body[65_000:130_000], body[130_000:]]
    hashes = [exact.fingerprint(p) for p in parts]
    left = exact.combine(exact.combine(hashes[0], hashes[1]), hashes[2])
    right = exact.combine(hashes[3], hashes[4])
    assert exact.combine(left, right) == whole and whole[2] == len(body)
    assert exact.fingerprint(b"\0a")[:2] != exact.fingerprint(b"a")[:2]


def test_colliding_fingerprints_are_found_by_comparison(spark):
    docs = spark.createDataFrame([(1, "same"), (2, "same"), (3, "one"), (4, "two")], "doc_id bigint, text string")
    prints = spark.createDataFrame([(1, 5, 4, "s"), (2, 5, 4, "s"), (3, 6, 3, "x"), (4, 6, 3, "y")],
                                   "doc_id bigint, fp bigint, n_bytes bigint, text_sha256 string")
    prints = prints.join(docs, "doc_id").withColumn("h", F.xxhash64("text")).drop("text")
    assert [tuple(r) for r in exact.differing_groups(docs, prints).collect()] == [(6, 3)]


def test_chunks_hashed_apart_give_the_fingerprint_of_the_text(spark):
    random.seed(5)
    long = ["".join(random.choice("abc \n\u00e9") for _ in range(n)) for n in (70_000, 300_000)]
    texts = [*long, long[1].replace(" ", "\t "), "short", "", None, " " * 100_000, "x" * exact.CHUNK, "x" * (exact.CHUNK + 1)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: (r["fp"], r["n_bytes"]) for r in exact.fingerprints(docs).collect()}
    for i, text in enumerate(texts):
        a, b, n = exact.fingerprint(exact.normalised(text))
        assert got[i] == (a << 31 | b, n)
    rows = {r["doc_id"]: r for r in exact.exact_dedup(docs).collect()}
    assert [rows[i]["keep_id"] for i in range(len(texts))] == [0, 1, 1, 3, 4, 4, 6, 7, 8]


def test_dedup_of_rows_without_ids(spark):
    """A third of the rows agrees in its null doc_id and text, another third has null doc_ids and other texts."""
    rows = [(None, "same  text")] * 100 + [(None, f"text {i}") for i in range(100)] + [(i, f"text {i}") for i in range(100)]
    got = exact.exact_dedup(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
    assert len(got) == 300 and sum(r["kept"] for r in got) == 101
    assert sorted(r["doc_id"] for r in got if r["kept"] and r["doc_id"] is not None) == list(range(100))


# ------------------------------------------------------------------ 7
def test_importance_prefers_the_target(spark):
    good = [(i, f"calm water runs over stone number{i} and on") for i in range(60)]
    bad = [(100 + i, f"win cash now click here offer{i} win cash now") for i in range(20)]
    docs = spark.createDataFrame(good + bad, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(100 + i, 0, 0) for i in range(10)],
                                   "doc_id bigint, quality int, toxic int")
    rows = importance.resample(docs, labels).collect()
    assert sum(r["selected"] for r in rows) == 60                   # 30 of 40 labelled are good
    assert sum(r["selected"] for r in rows if r["doc_id"] < 100) >= 58
    again = importance.resample(docs.repartition(7), labels).collect()
    assert {r["doc_id"] for r in rows if r["selected"]} == {r["doc_id"] for r in again if r["selected"]}


def test_importance_counts_equal_a_plain_count(spark):
    docs = documents(spark).where("doc_id is not null")
    target = spark.createDataFrame([(1,), (8,)], "doc_id bigint")
    raw, good = importance.ngram_models(docs, target, 64)
    want = sum(np.bincount(importance.ngram_buckets(r["text"], 64), minlength=64) for r in docs.collect())
    some = sum(np.bincount(importance.ngram_buckets(r["text"], 64), minlength=64) for r in docs.where("doc_id in (1, 8)").collect())
    assert (raw == want).all() and (good == some).all()


def test_gumbel_draws_follow_importance(spark):
    """Without a difference in weights each document is as likely as any other to be among the first half."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    keys = importance.importance(docs, np.zeros(16)).toPandas().sort_values("gumbel_key")
    assert keys.gumbel_key.mean() == pytest.approx(0.5772, abs=0.08)
    assert (keys.doc_id.iloc[:2000] < 2000).mean() == pytest.approx(0.5, abs=0.04)


# ------------------------------------------------------------------ 8
def test_clause_grammar():
    g = toxicity.Grammar({"dolt": 2.0})
    plain = g.clauses("What a dolt.")[0][0][0]
    assert plain == 2.0
    assert g.clauses("You are a dolt.")[0][0][0] == plain * toxicity.AIMED
    assert g.clauses("That is not a dolt.")[0][0][0] == plain * toxicity.NEGATED
    assert g.clauses("They said a dolt.")[0][0][0] < plain * toxicity.AIMED
    assert g.clauses("I will kill you!")[0][0][0] == toxicity.THREAT
    assert g.clauses("Kill the lights. You may go.")[0] == []
    assert g.clauses("dolts. doltish; fine") == ([(2.0, ["dolt"]), (2.0, ["dolt"])], 3)


def test_reported_speech_before_and_behind():
    g = toxicity.Grammar({"dolt": 2.0})
    aimed = 2.0 * toxicity.AIMED
    for text in ('She said "you dolt".', '"You dolt", she said.', '"You dolt!" she said.', "«You dolt.» dit le chat"):
        matched, n = g.clauses(text)
        assert (matched[0][0], n) == (pytest.approx(aimed * toxicity.REPORTED), 1), text
    assert g.clauses('"You dolt!" Then nothing. He said so.')[0][0][0] == aimed
    assert g.clauses("They reported: I will kill you")[0][0][0] == toxicity.THREAT
    assert g.clauses("I will kill you, he said")[0][0][0] == pytest.approx(toxicity.THREAT * toxicity.REPORTED)


def in_turn(cascade, symbols):
    """The symbols read by one transducer after the other, each over the whole text: (symbol out, product of factors)."""
    tape = [(s, 1.0) for s in symbols]
    for rows in cascade:
        table, state, out = toxicity.keyed(rows), 0, []
        for symbol, product in tape:
            state, symbol, factor = toxicity.step(table, state, symbol)
            out.append((symbol, product * factor))
        tape = out
    return tape


def test_composed_machine_equals_the_transducers_in_turn():
    assert 20 < len(toxicity.MACHINE) <= 64 and all(set(arcs) == set(toxicity.SYMBOLS) for arcs in toxicity.MACHINE)
    rng = random.Random(4)
    for _ in range(400):
        symbols = rng.choices(toxicity.SYMBOLS, weights=(5, 2, 2, 2, 2, 1, 2), k=rng.randrange(40))
        state, got = 0, []
        for symbol in symbols:
            state, out, factor = toxicity.MACHINE[state][symbol]
            got.append((out, factor))
        assert got == [(s, pytest.approx(f)) for s, f in in_turn(toxicity.CASCADE, symbols)]


@pytest.mark.parametrize("n_clean,n_toxic", [(0, 0), (1, 1), (6, 1), (0, 5), (5, 0), (0, 1)])
def test_few_labels_leave_clean_documents(spark, n_clean, n_toxic):
    texts = ["a quiet evening by the river", "You are an idiot and a moron. I will kill you!", "", None, "tea and bread, then sleep",
             "They said no to that plan"]
    ids = {i: texts[i % 6] for i in range(30)}
    docs = spark.createDataFrame(list(ids.items()), "doc_id bigint, text string")
    trained = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2]
    clean = [i for i in trained if i < 30 and i % 6 != 1][:n_clean]
    toxic = [i for i in trained if i < 30 and i % 6 == 1][:n_toxic]
    toxic += [i for i in trained if i > 100][:n_toxic - len(toxic)]         # the rest has no document
    labels = spark.createDataFrame([(i, 1, 0) for i in clean] + [(i, 0, 1) for i in toxic], "doc_id bigint, quality int, toxic int")
    rows = toxicity.score_toxicity(docs, labels).collect()
    for r in rows:
        assert (r["predicted"] == 1) == (r["doc_id"] % 6 == 1), (r, n_clean, n_toxic)
    assert {r["doc_id"] for r in toxicity.drop_toxic(docs, labels).collect()} == {i for i in ids if i % 6 != 1}


def test_the_fit_without_labels_is_the_fixed_scale(spark):
    none = spark.createDataFrame([], "toxic int, " + ", ".join(f"{f} double" for f in toxicity.FEATURES))
    weights, bias = toxicity.fit_scale(none)
    for x in toxicity.PRIOR_POINTS:
        want = toxicity.FIXED_BIAS + sum(a * b for a, b in zip(toxicity.FIXED_WEIGHTS, x))
        assert bias + sum(a * b for a, b in zip(weights, x)) == pytest.approx(want, abs=0.1)


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op8_score_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    hit = Counter((r["toxic"], r["predicted"]) for r in held)
    assert hit[1, 1] >= 0.85 * (hit[1, 1] + hit[1, 0])
    assert hit[0, 1] <= 0.05 * (hit[0, 1] + hit[0, 0])


def test_toxicity_scores_do_not_depend_on_the_cap(spark):
    """A word of six in ten toxic and one in ten clean documents, 11 % toxic: cut to as many of either, scores stay."""
    random.seed(8)
    vocabulary, rows = ["".join(random.choices("mnoprstu", k=6)) for _ in range(300)], []
    for i in range(1800):
        toxic = int(i % 9 == 0)
        words = random.choices(vocabulary, k=30)
        if random.random() < (0.6 if toxic else 0.1):
            words[7] = "blargish"
        rows.append((i, " ".join(words) + ".", 1, toxic))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, quality int, toxic int")
    asked = {"plain": " ".join(vocabulary[:30]), "marked": " ".join([*vocabulary[:29], "blargish"])}
    whole, cut = ({k: m.score(x) for k, x in asked.items()}
                  for m in (toxicity.train_toxicity(docs, docs, n) for n in (10_000, 120)))
    assert whole["plain"] < 0.15 and 0.3 < whole["marked"] < 0.6
    assert cut == pytest.approx(whole, abs=0.12)


# ------------------------------------------------------------------ 9
def test_ring_bounds_and_movement(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before, after = ({r["doc_id"]: r for r in sharding.shard_documents(docs, n, slack=0.1).collect()} for n in (16, 17))
    loads = Counter()
    for r in before.values():
        loads[r["shard"]] += r["size"]
    mean, most = sum(loads.values()) / 16, max(r["size"] for r in before.values())
    assert max(loads.values()) <= 1.1 * mean + most
    moved = sum(before[i]["shard"] != after[i]["shard"] for i in before) / len(before)
    assert moved < 0.3                          # a fresh hash would move 94 %


def test_equal_sizes_are_drawn_alike_in_every_run(spark):
    """Rows that agree in doc_id, source and size but not in text; a column of a map beside them."""
    docs = spark.createDataFrame([(None, f"word{i} and", "s" if i % 2 else "t", {"k": i}) for i in range(40)],
                                 "doc_id bigint, text string, source string, extra map<string, int>")
    runs = [sorted(r["text"] for r in mixed_documents(docs.repartition(n)).collect()) for n in (2, 5)]
    assert runs[0] == runs[1] and len(runs[0]) >= 40


def test_a_third_of_equal_rows_is_spread(spark):
    rows = [(None, None)] * 700 + [(i, f"text {i} " * (i % 9 + 1)) for i in range(1400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    placed = sharding.shard_documents(docs).collect()
    loads, slots = Counter(), defaultdict(list)
    for r in placed:
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(placed) == 2100 and max(loads.values()) <= 1.05 * min(loads.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    packed = packing.pack_documents(docs.select("doc_id", F.when(F.col("doc_id") < 300, F.col("text")).alias("text")), group_pieces=300)
    seen = defaultdict(list)
    for r in packed.collect():
        seen[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sum(map(len, seen.values())) == 2100
    groups = Counter((s - 1) // 2 >> 31 for s, pieces in seen.items() for _ in pieces)
    assert len(groups) == 7 and max(groups.values()) < 420
    for pieces in seen.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_ring_loads_are_near_equal(spark):
    rows = QUERIES["op9_ring_shards"](spark, "/root/testdata/sf0.01").collect()
    loads, slots = Counter(), defaultdict(list)
    for r in rows:
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(loads) == 16 and max(loads.values()) <= 1.05 * min(loads.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


# ------------------------------------------------------------------ 10
def test_tokens_equal_the_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    words = packing.word_ids(None)
    odd = ["İstanbul ΣΑΣ ß×÷ ÀÉŽž ŉ ﬁ é ́x", "it's IT'S don't'll 12a3", "<|endoftext|>x <|startoftext|>", "\x1c a\x85b c", ""]
    for text in [*texts(spark).values(), *odd]:
        ids = plain.encode(text, add_special_tokens=False).ids
        assert words.of_text(text) == np.asarray(ids, dtype="<u4").tobytes()


def test_word_cache_ends_with_its_task(spark):
    docs = spark.createDataFrame([(i, f"some words of document number{i}") for i in range(400)], "doc_id bigint, text string")

    def held(batches):
        import gc
        n = sum(isinstance(x, packing.WordIds) for x in gc.get_objects())
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([n] * batch.num_rows, pa.int64())})
    assert packing.document_pieces(docs.repartition(4)).count() == 400
    kept = docs.repartition(8).mapInArrow(held, "n bigint").collect()      # in workers that the pieces were made in
    assert len(kept) == 400 and {r["n"] for r in kept} == {0}
    a, b = packing.word_ids(None), packing.word_ids(None)
    assert a["word"] and not b and a.tokenizer is b.tokenizer


def test_packing_is_near_the_lower_bound():
    random.seed(4)
    for draw in (lambda: random.randint(1, 2047), lambda: random.randint(600, 1100), lambda: int(random.lognormvariate(6, 1)) % 2047 + 1):
        lengths = [draw() for _ in range(4000)]
        places = packing.pack_lengths(lengths)
        bins = defaultdict(list)
        for n, (b, offset) in zip(lengths, places):
            bins[b].append((offset, n))
        for spans in bins.values():
            assert sum(n for _, n in spans) <= 2048
            assert all(o == sum(n for p, n in spans if p < o) for o, _ in spans)
        assert len(bins) <= len(packing.best_fit(lengths, 2048).items)


def test_local_search_swaps():
    bins = packing.Bins(10)
    for items in ([6, 2], [4, 3], [3]):         # 6 2 | 4 3 | 3: two bins are enough only after an exchange
        bins.items.append([(n, 10 * len(bins.items) + i) for i, n in enumerate(items)])
        bins.fill.append(sum(items))
    packing.local_search(bins)
    assert sorted(f for f in bins.fill if f) == [8, 10] and bins.fill.count(0) == 1
