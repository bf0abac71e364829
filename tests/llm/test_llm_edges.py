"""Every operator on awkward documents, and on none."""

import zlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from frames import LONG, ROWS, documents, empty
from trustfeed.llm.exact_dedup import exact_dedup, normalised
from trustfeed.llm.html_blocks import extract_main
from trustfeed.llm.importance import resample
from trustfeed.llm.line_templates import dedup_lines, drop_recurring
from trustfeed.llm.mixing import mix_sources, mixed_documents
from trustfeed.llm.near_dedup import drop_near_duplicates, near_classes
from trustfeed.llm.packing import pack_documents
from trustfeed.llm.quality import quality_rules
from trustfeed.llm.sharding import shard_documents
from trustfeed.llm.toxicity import drop_toxic, score_toxicity

LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 0, 1), (8, 1, 1), (6, None, None), (None, 1, 1), (1, 1, 0)], LABELS)


def ids(rows):
    return Counter(r["doc_id"] for r in rows)


ALL_IDS = Counter(r[0] for r in ROWS)


def test_one_row_per_document(spark, labels):
    docs = documents(spark)
    for result in (near_classes(docs), dedup_lines(docs), mix_sources(docs), quality_rules(docs), exact_dedup(docs),
                   resample(docs, labels), score_toxicity(docs, labels), shard_documents(docs)):
        assert ids(result.collect()) == ALL_IDS, result.columns


def test_no_documents(spark, labels):
    docs, none = empty(spark), labels.where("doc_id < 0")
    for result in (near_classes(docs), dedup_lines(docs), mix_sources(docs), mixed_documents(docs), quality_rules(docs),
                   exact_dedup(docs), resample(docs, none), score_toxicity(docs, none), shard_documents(docs),
                   pack_documents(docs), drop_near_duplicates(docs), drop_recurring(docs), drop_toxic(docs, none)):
        assert result.collect() == [], result.columns


def test_filters_keep_columns(spark, labels):
    docs = documents(spark)
    for result in (drop_near_duplicates(docs), drop_recurring(docs), drop_toxic(docs, labels), mixed_documents(docs)):
        assert result.columns == docs.columns
        result.collect()


def test_exact_dedup_edges(spark):
    rows = exact_dedup(documents(spark)).collect()
    by_text = defaultdict(list)
    for r in rows:
        by_text[r["text_sha256"]].append(r)
    for group in by_text.values():
        assert sum(r["kept"] for r in group) == 1
        assert {r["group_size"] for r in group} == {len(group)}
        known = [r["doc_id"] for r in group if r["doc_id"] is not None]
        assert {r["keep_id"] for r in group} == {min(known) if known else None}
    kept = {r["doc_id"] for r in rows if r["kept"]}
    assert 1 in kept and 2 not in kept and 3 in kept and 4 not in kept and 5 in kept and 9007199254740993 in kept


def test_near_classes_edges(spark):
    rows = near_classes(documents(spark)).collect()
    class_of = {r["doc_id"]: r["class_id"] for r in rows if r["doc_id"] is not None}
    assert class_of[1] == class_of[2] == 1          # white space and copies
    assert class_of[3] == class_of[4] == class_of[5] == 3
    assert class_of[6] == class_of[7] == 6          # one word more in a very long text
    assert class_of[8] == 8
    assert sum(r["kept"] for r in rows) == len({r["class_id"] for r in rows}) == 7


def test_mixing_edges(spark):
    docs = documents(spark)
    rows = mix_sources(docs).collect()
    assert all(r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2 for r in rows)
    assert sum({r["source"]: r["target"] for r in rows}.values()) == pytest.approx(1.5 * sum(r["size"] for r in rows))
    assert mixed_documents(docs).count() == sum(r["copies"] for r in rows)


def test_packing_edges(spark):
    rows = pack_documents(documents(spark)).collect()
    places, lengths = defaultdict(list), Counter()
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        lengths[r["doc_id"], r["piece"]] += 1
    for spans in places.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 2048
    empty_crc = zlib.crc32(b"\0\0\0\0")
    assert [(r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] in (3, 4, 5)] == [(1, empty_crc)] * 3
    assert lengths[2, 0] == 2 and max(p for d, p in lengths if d == 6) > 5


def test_sharding_edges(spark):
    rows = shard_documents(documents(spark), shards=3).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = {r[0]: r[1] for r in ROWS}
    for r in rows:
        if r["doc_id"] is not None:
            body = (texts[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(body) + 1, zlib.crc32(body))


def test_line_dedup_edges(spark):
    docs = documents(spark)
    text = {r["doc_id"]: r["text"] for r in dedup_lines(docs).collect() if r["doc_id"] is not None}
    assert text[1] and text[3] is None and text[4] == "" and text[5] == " \t\n "
    assert text[2] == ""                        # its only line is that of document 1
    assert 2 not in {r["doc_id"] for r in drop_recurring(docs).collect()}


def test_quality_edges(spark):
    rows = {r["doc_id"]: r for r in quality_rules(documents(spark)).collect()}
    assert rows[3]["n_words"] == 0 and rows[3]["base_failed"] and not rows[3]["kept"]
    assert rows[6]["n_repeat_words"] == len(LONG.split()) and rows[6]["base_failed"]


def test_pages_edges(spark):
    rows = [(1, None, "u"), (2, "", None), (None, "<p>no id", "u"), (3, "plain text only", "u"), (3, "plain text only", "u"),
            (4, "<article>" + "<p>x y</p>" * 50_000, "u")]
    pages = spark.createDataFrame(rows, "page_id bigint, html string, url string").selectExpr("*", "'t' as text", "1 as n_chars_")
    got = sorted(((r["page_id"] or 0), r["n_chars"], r["text"][:15]) for r in extract_main(pages).collect())
    assert got == [(0, 5, "no id"), (1, 0, ""), (2, 0, ""), (3, 15, "plain text only"), (3, 15, "plain text only"),
                   (4, 199_999, "x y\nx y\nx y\nx y")]
    assert extract_main(pages.where("page_id < 0")).collect() == []


@pytest.mark.parametrize("rows", [ROWS, []])
def test_pipeline_stages_on_edges(spark, tmp_path, rows):
    docs = documents(spark, rows) if rows else empty(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (8, 1, 1)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(corpus_pipeline.STAGES) == 5
    assert bool(out) == bool(rows)
    if rows:
        # the clean documents with words of their own: repeats of them are what line and near dedup drop, and mixing may take
        # a document not at all
        held = {r["doc_id"] for r in out}
        assert held <= {r[0] for r in rows} - {2, 7} and len(held) > 3


def test_pipeline_stages_bound_text_batches(spark, tmp_path, monkeypatch):
    import pyarrow as pa

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "bytes": [batch.nbytes]})
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.range(60).selectExpr("id as doc_id", "repeat(concat('word', id, ' '), 30000) as text").coalesce(1) \
        .write.parquet(f"{tmp_path}/documents.parquet")                     # 12 MB or more
    spark.createDataFrame([(1, 1, 0)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    for name in ("drop_toxic", "drop_recurring", "drop_near_duplicates", "mixed_documents", "pack_documents"):
        monkeypatch.setattr(corpus_pipeline, name, lambda docs, *_: docs.coalesce(1).mapInArrow(sizes, "n bigint, bytes bigint"))
    own = spark.conf.get(key, None)
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.unset(key)
            rows = stage(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)).collect()
            assert sum(r["n"] for r in rows) == 60 and max(r["bytes"] for r in rows) < 6_000_000
        spark.conf.set(key, "1m")                                          # a bound of the session's own holds
        corpus_pipeline.mixing(spark, spark.range(1), str(tmp_path))
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key) if own is None else spark.conf.set(key, own)


def test_normalised_text():
    assert normalised("a \t\n b c") == "a b c".encode() and normalised(None) == b""
