"""The corpus pipeline: toxicity filter, line dedup, near-dedup, mixing, packing.

STAGES lists (name, function). Each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet in the shared folder and read again as the next stage's docs. All but the last return the columns of documents.

* toxicity: documents that the clause grammar scores 0.3 or more go; it learns from the rows that have labels.
* line dedup: lines of recurring templates go from all documents but the first; a document left without any word goes.
* near-dedup: one document of each class stays, the one with the smallest doc_id.
* mixing: each document is repeated as often as the mix draws it (0 to 2 times); later copies are rows of their own.
* packing: the pieces of the documents with their places in sequences of 2048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trustfeed.llm.line_templates import drop_recurring
from trustfeed.llm.mixing import mixed_documents
from trustfeed.llm.near_dedup import drop_near_duplicates
from trustfeed.llm.packing import pack_documents
from trustfeed.llm.toxicity import drop_toxic
from trustfeed.session import apply_text_conf, materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    apply_text_conf(spark)
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    apply_text_conf(spark)
    return drop_recurring(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    apply_text_conf(spark)
    return drop_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    apply_text_conf(spark)
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    apply_text_conf(spark)
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mixing),
          ("packing", packing)]

# The toxicity model, the near-duplicate classes and the tokenizer are beyond SQL; tests/llm holds each stage against
# a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
