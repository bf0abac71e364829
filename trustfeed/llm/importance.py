"""Quality selection by importance resampling over hashed n-grams.

Two bag-of-n-grams models are counted over hashed words and word pairs: one of the raw corpus (all documents) and one of the
target (documents labelled good, a bounded sample of them: at most ``MAX_TARGET``, those with the smallest hash of
doc_id). A document's log importance is the sum over its n-grams of log p(target) - log p(raw). A Gumbel draw, fixed
by the document's id and text, is added, and the ``k`` documents with the largest keys are selected, which is a sample
without replacement in proportion to importance.

``k`` follows the data: the share of good ones among the labelled documents, times all documents.

The counts are two vectors of ``BUCKETS`` numbers, added up per task before they are shuffled; they are the same size for any
corpus. The largest keys are found by the order of all keys over all tasks, not in one of them.

Edge cases: null and empty texts have no n-grams and log importance 0; without labelled rows everything is selected; ties are
ordered by doc_id; repeated rows get equal draws; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustfeed.llm.common import arrow_rows, texts_of
from trustfeed.llm.near_dedup import mix, word_hashes
from trustfeed.operators.global_rank import global_row_number
from trustfeed.session import materialize

BUCKETS = 1 << 14
MAX_TARGET = 20_000
SMOOTH = 1.0

_COUNTS = pa.schema([("bucket", pa.int32()), ("raw", pa.int64()), ("target", pa.int64())])


def ngram_buckets(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """The buckets of a text's words and neighbouring word pairs."""
    words = word_hashes(text or "")
    pairs = mix(words[:-1] + mix(words[1:]))
    return (np.concatenate([mix(words), pairs]) % np.uint64(buckets)).astype(np.int64)


def ngram_models(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(raw counts, target counts) per bucket; ``target`` holds at most MAX_TARGET doc_ids."""
    marked = docs.select("doc_id", "text").join(
        F.broadcast(target.select(F.col("doc_id").alias("id_"), F.lit(1).alias("good"))), F.col("doc_id") == F.col("id_"), "left")

    def count(batches):
        raw, good = np.zeros(buckets, dtype=np.int64), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text, is_good in texts_of(batch, "text", "good"):
                one = np.bincount(ngram_buckets(text, buckets), minlength=buckets)
                raw += one
                if is_good:
                    good += one
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(raw[seen]), pa.array(good[seen])], schema=_COUNTS)

    sums = marked.select("text", "good").mapInArrow(count, "bucket int, raw bigint, target bigint") \
        .groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect()    # one row per bucket
    raw, good = np.zeros(buckets), np.zeros(buckets)
    for b, r, g in sums:
        raw[b], good[b] = r, g
    return raw, good


def log_ratios(raw: np.ndarray, good: np.ndarray, smooth: float = SMOOTH) -> np.ndarray:
    """log p(target) - log p(raw) per bucket; the target's counts are smoothed towards the raw model."""
    p = (raw + smooth) / (raw.sum() + smooth * len(raw))
    prior = smooth * len(raw)
    q = (good + prior * p) / (good.sum() + prior)
    return np.log(q) - np.log(p)


def importance(docs: DataFrame, ratios: np.ndarray, seed: int = 1) -> DataFrame:
    """doc_id, log_weight and Gumbel key of each document."""
    buckets = len(ratios)
    schema = pa.schema([("doc_id", pa.int64()), ("draw", pa.int64()), ("log_weight", pa.float64())])

    def weigh(batches):
        for batch in batches:
            yield arrow_rows([(d, h, float(ratios[ngram_buckets(t, buckets)].sum()))
                              for d, h, t in texts_of(batch, "doc_id", "draw", "text")], schema)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("doc_id", "text", F.lit(seed)).alias("draw"), "text")
    weighed = rows.mapInArrow(weigh, "doc_id bigint, draw bigint, log_weight double")
    u = (F.shiftrightunsigned("draw", 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return weighed.select("doc_id", "log_weight", (F.col("log_weight") - F.log(-F.log(u))).alias("gumbel_key"))


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, max_target: int = MAX_TARGET,
             buckets: int = BUCKETS, seed: int = 1) -> DataFrame:
    """One row per document: doc_id, log_weight, gumbel_key, selected."""
    rated = labels.where("quality is not null and doc_id is not null")
    good = rated.where("quality = 1").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_target)
    raw, target = ngram_models(docs, materialize(good, "importance-target"), buckets)
    scored = materialize(importance(docs, log_ratios(raw, target), seed), "importance")
    if k is None:
        n_rated, n_good = rated.agg(F.count("doc_id"), F.count(F.when(F.col("quality") == 1, 1))).first()
        k = -(-scored.count() * n_good // n_rated) if n_rated else scored.count()
    ranked = global_row_number(scored, [F.col("gumbel_key").desc(), F.col("doc_id"), F.col("log_weight")], "place")
    return ranked.select("doc_id", "log_weight", "gumbel_key", (F.col("place") <= k).alias("selected"))
