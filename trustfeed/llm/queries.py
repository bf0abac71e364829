"""The registered queries of the text operators and their DuckDB oracles."""

from __future__ import annotations

import corpus_pipeline
from trustfeed.llm.common import table
from trustfeed.llm.exact_dedup import exact_dedup
from trustfeed.llm.html_blocks import extract_main
from trustfeed.llm.importance import resample
from trustfeed.llm.lexical_search import lexical_search
from trustfeed.llm.line_templates import dedup_lines
from trustfeed.llm.mixing import mix_sources
from trustfeed.llm.near_dedup import near_classes
from trustfeed.llm.packing import pack_documents
from trustfeed.llm.periodic_runs import periodic_runs
from trustfeed.llm.quality import quality_rules
from trustfeed.llm.sharding import shard_documents
from trustfeed.llm.toxicity import score_toxicity
from trustfeed.llm.weighted_sampling import neighbour_fingerprints


def op1_near_classes(spark, sf_dir):
    return near_classes(table(spark, sf_dir, "documents"))


def op2_drop_recurring_lines(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, n_lines="n_lines", n_dropped="n_dropped")


def op3_mix_sources(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents"))


def op4_extract_main(spark, sf_dir):
    return extract_main(table(spark, sf_dir, "pages"))


def op5_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


def op10_pack_documents(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"))


def op7_importance_resample(spark, sf_dir):
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_score_toxicity(spark, sf_dir):
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_ring_shards(spark, sf_dir):
    return shard_documents(table(spark, sf_dir, "documents"))


def op11_fingerprint_documents(spark, sf_dir):
    return neighbour_fingerprints(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark, sf_dir):
    return periodic_runs(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark, sf_dir):
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_near_classes, op2_drop_recurring_lines, op3_mix_sources, op4_extract_main, op5_quality_rules, op6_exact_dedup,
    op7_importance_resample, op8_score_toxicity, op9_ring_shards, op10_pack_documents,
    op11_fingerprint_documents, op12_periodic_runs, op13_lexical_search)}
QUERIES["pipeline"] = corpus_pipeline.run

ORACLES = {
    "op3_mix_sources": r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s
), c AS (
  SELECT *,
    coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS capped,
    sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS open_weight,
    sum(source_size) OVER ()::DOUBLE AS all_size
  FROM w
), l AS (
  SELECT *, (1.5::DOUBLE * all_size - 2 * capped) / open_weight AS own_level FROM c
), t AS (
  SELECT *, max(CASE WHEN own_level * weight < 2 * source_size THEN own_level END) OVER () AS level FROM l
), r AS (
  SELECT source, source_size, least((2 * source_size)::DOUBLE, coalesce(level * weight, (2 * source_size)::DOUBLE)) AS target,
    ('0x' || substr(md5(coalesce(source, chr(0))), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM t
), n AS (
  SELECT d.doc_id, d.source, d.size, r.source_size, r.target, r.u,
    CASE WHEN r.source_size > 0 THEN r.target / r.source_size ELSE 0.0::DOUBLE END AS rate,
    row_number() OVER (PARTITION BY d.source ORDER BY d.size DESC, d.doc_id) AS k
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
), x AS (
  SELECT *, least(floor(u + k * rate) - floor(u + (k - 1) * rate), 2)::BIGINT AS copies FROM n
)
SELECT doc_id, source, size, source_size, target, copies, copies * size AS taken FROM x
""",
    "op6_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
)
SELECT doc_id, keep_id, group_size,
  doc_id IS NOT DISTINCT FROM keep_id AND row_number() OVER (PARTITION BY text_sha256, doc_id) = 1 AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
""",
    "op2_drop_recurring_lines": r"""
WITH raw AS (
  SELECT doc_id, generate_subscripts(ls, 1) - 1 AS pos, regexp_extract_all(unnest(ls), '[^\x20\x09-\x0D]+') AS words
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL)
), masked AS (
  SELECT doc_id, pos, words, list_transform(words, lambda x: CASE WHEN regexp_matches(x, '[0-9]|@|://|^www\.') THEN '<*>' ELSE x END) AS m
  FROM raw WHERE len(words) > 0
), line AS (
  -- a line of variable fields only keeps them
  SELECT doc_id, pos, len(words) AS n, CASE WHEN len(list_filter(m, lambda x: x <> '<*>')) = 0 THEN words ELSE m END AS tokens
  FROM masked
), kind AS MATERIALIZED (
  SELECT n, tokens, CASE WHEN n < 6 THEN tokens ELSE tokens[1:4] END AS head,
    count(DISTINCT doc_id) AS docs, min(doc_id) AS lo, max(doc_id) AS hi FROM line GROUP BY n, tokens
), token AS MATERIALIZED (
  SELECT n, head, tokens, docs, unnest(tokens) AS word, generate_subscripts(tokens, 1) AS place FROM kind
), short AS (
  -- the documents of a short line against those that chance gives it
  SELECT tokens, lo FROM kind JOIN (SELECT n, sum(docs) AS all_docs, count(*) AS kinds FROM kind GROUP BY n) USING (n)
  JOIN (SELECT tokens, list(votes ORDER BY place) AS votes
        FROM token JOIN (SELECT n, place, word, count(*) AS votes FROM token WHERE n < 6 GROUP BY n, place, word) USING (n, place, word)
        WHERE docs > 1 GROUP BY tokens) USING (tokens)
  WHERE n < 6 AND docs > 1 AND docs > all_docs * list_reduce(list_prepend(1.0::DOUBLE, votes), lambda x, y: x * (y - 1) / greatest(kinds - 1, 1))
    + 4 * sqrt(all_docs * list_reduce(list_prepend(1.0::DOUBLE, votes), lambda x, y: x * (y - 1) / greatest(kinds - 1, 1)))
), leaf AS (
  SELECT n, head, count(*) AS size FROM kind WHERE n >= 6 GROUP BY n, head HAVING min(lo) <> max(hi)
), template AS (
  SELECT n, head, place, word FROM token JOIN leaf USING (n, head) GROUP BY n, head, place, word, size HAVING count(*) * 2 > size
), agreed AS (
  SELECT tokens, count(*) >= any_value(n) * 0.7::DOUBLE AS alike FROM token JOIN template USING (n, head, place, word) GROUP BY tokens
), member AS (
  SELECT n, head, tokens, lo, hi, CASE WHEN alike THEN []::VARCHAR[] ELSE tokens END AS own
  FROM kind JOIN leaf USING (n, head) LEFT JOIN agreed USING (tokens)
), gone AS (
  SELECT tokens, first AS lo FROM member
  JOIN (SELECT n, head, own, min(lo) AS first, max(hi) AS last FROM member GROUP BY n, head, own) USING (n, head, own)
  WHERE first <> last
  UNION ALL SELECT tokens, lo FROM short
), places AS (
  SELECT doc_id, list(DISTINCT pos) AS places FROM line JOIN gone USING (tokens) WHERE doc_id <> lo GROUP BY doc_id
), d AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS ls, places FROM documents LEFT JOIN places USING (doc_id)
)
SELECT doc_id,
  CASE WHEN places IS NULL THEN text ELSE array_to_string(
    list_transform(list_filter(range(len(ls)), lambda i: NOT list_contains(places, i)), lambda i: ls[i + 1]), chr(10)) END AS text,
  coalesce(len(ls), 0) AS n_lines, coalesce(len(places), 0) AS n_dropped
FROM d
""",
    "op5_quality_rules": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
), g AS (
  SELECT r, i, list_slice(words, i, i + 7) AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)
), cov AS (
  SELECT r, count(DISTINCT j) AS n FROM (
    SELECT r, unnest(range(i, i + 8)) AS j FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM g) WHERE c > 1)
  GROUP BY r
), c AS (
  SELECT r, doc_id, lang, source, len(words)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN cov USING (r)
), s AS (
  SELECT *, CASE WHEN word_chars > 0 THEN n_symbols * 10000 // word_chars ELSE 0 END AS symbols,
    CASE WHEN n_lines > 0 THEN n_dup_lines * 10000 // n_lines ELSE 0 END AS dup_lines,
    CASE WHEN n_words > 0 THEN n_repeat_words * 10000 // n_words ELSE 0 END AS repeated,
    CASE WHEN n_words > 0 THEN word_chars * 10000 // n_words ELSE 0 END AS word_length FROM c
), u AS (
  SELECT lang, source, share, greatest(length(bin(v)) - 6, 0) AS low, v
  FROM (UNPIVOT s ON symbols, dup_lines, repeated, word_length INTO NAME share VALUE v)
), b AS (
  SELECT lang, source, share, (v >> low) << low AS bucket, count(*) AS n FROM u GROUP BY ALL
), x AS (
  SELECT 1 AS level, lang, source, share, bucket, n FROM b
  UNION ALL SELECT 2, lang, NULL, share, bucket, sum(n) FROM b GROUP BY lang, share, bucket
  UNION ALL SELECT 3, NULL, NULL, share, bucket, sum(n) FROM b GROUP BY share, bucket
), q AS (
  SELECT level, lang, source, share, any_value(size) AS size, min(bucket) FILTER (WHERE upto * 1000 >= size * 100) AS low,
    min(bucket) FILTER (WHERE upto * 1000 >= size * 500) AS mid
  FROM (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, share ORDER BY bucket) AS upto,
          sum(n) OVER (PARTITION BY level, lang, source, share) AS size FROM x)
  GROUP BY level, lang, source, share
), lim AS (
  SELECT level, lang, source, share, size, mid + 3 * (mid - low) + margin AS top, mid - 3 * (mid - low) - margin AS bottom
  FROM q JOIN (VALUES ('symbols', 300), ('dup_lines', 4000), ('repeated', 2000), ('word_length', 20000)) AS m(share, margin)
    USING (share)
), pick AS (
  SELECT f.lang, f.source, f.share,
    CASE WHEN f.size >= 50 THEN f.top WHEN l.size >= 50 THEN l.top ELSE a.top END AS top,
    CASE WHEN f.size >= 50 THEN f.bottom WHEN l.size >= 50 THEN l.bottom ELSE a.bottom END AS bottom
  FROM lim AS f JOIN lim AS l ON l.level = 2 AND l.share = f.share AND l.lang IS NOT DISTINCT FROM f.lang
  JOIN lim AS a ON a.level = 3 AND a.share = f.share WHERE f.level = 1
), z AS (
  SELECT lang, source, max(top) FILTER (WHERE share = 'symbols') AS t1, max(top) FILTER (WHERE share = 'dup_lines') AS t2,
    max(top) FILTER (WHERE share = 'repeated') AS t3, max(top) FILTER (WHERE share = 'word_length') AS t4,
    max(bottom) FILTER (WHERE share = 'word_length') AS b4 FROM pick GROUP BY lang, source
), y AS (
  SELECT s.*, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    symbols <= t1 AND dup_lines <= t2 AND repeated <= t3 AND word_length <= t4 AND word_length >= b4 AS within
  FROM s JOIN z ON s.lang IS NOT DISTINCT FROM z.lang AND s.source IS NOT DISTINCT FROM z.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND within AS kept FROM y
""",
    "op13_lexical_search": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), i AS (
  SELECT row_number() OVER () AS r, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark
), n AS (
  SELECT row_number() OVER () AS doc, doc_id, len(terms)::BIGINT AS n, terms FROM d WHERE len(terms) > 0
), a AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM n
), p AS (
  SELECT doc, term, count(*)::BIGINT AS tf FROM (SELECT doc, unnest(terms) AS term FROM n) GROUP BY doc, term
), q AS (
  SELECT r, item_id, term, count(*)::BIGINT AS qtf FROM (SELECT r, item_id, unnest(terms) AS term FROM i) GROUP BY r, item_id, term
), w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, a GROUP BY term, docs
), s AS (
  SELECT r, item_id, doc, sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN n USING (doc), a GROUP BY r, item_id, doc
)
SELECT item_id, (row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score
FROM s JOIN n USING (doc) WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id NULLS LAST) <= 10
""",
}
