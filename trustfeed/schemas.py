"""Fixed schemas of the source, feature, prediction and feed tables, and
type enforcement at the edge (B9).

Enforcement uses ``try_cast`` so a malformed value becomes NULL instead of
failing the job (Spark 4 runs with ANSI casts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, DoubleType, LongType, StringType, StructField,
                               StructType, TimestampType)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, L, D, B, TS = StringType(), LongType(), DoubleType(), BooleanType(), TimestampType()

PROFILE = _schema(("profile_id", S), ("handle", S), ("owned_by", S), ("profile_picture_s3_url", S),
                  ("metadata_block_timestamp", TS))
GLOBALTRUST = _schema(("strategy_name", S), ("i", S), ("v", D), ("date", DateType()))
PROFILE_POST = _schema(("post_id", S), ("profile_id", S), ("contract_publication_id", S),
                       ("is_related_to_post", S), ("is_related_to_comment", S), ("is_hidden", S),
                       ("is_gated", S), ("block_timestamp", TS), ("language", S), ("region", S),
                       ("content_warning", S), ("main_content_focus", S), ("tags_vector", S),
                       ("custom_filters_gardener_flagged", S), ("content_uri", S))
PUBLICATION_STATS = _schema(("publication_id", S), ("total_amount_of_mirrors", L),
                            ("total_amount_of_collects", L), ("total_amount_of_comments", L),
                            ("total_upvotes", L), ("total_downvotes", L), ("datastream_metadata", S))

# ---------------------------------------------------------------- fixed values: names of the source and feature tables
# Columns of the post table that the features are made of, in the table's order.
POST_SOURCE_COLUMNS = [
    "post_id", "profile_id", "is_related_to_post", "is_related_to_comment", "is_hidden", "is_gated", "block_timestamp",
    "language", "region", "content_warning", "main_content_focus", "tags_vector", "custom_filters_gardener_flagged",
]
# Counters of the statistics table, in its order, and the features that they become.
STATS_TO_FEATURES = {
    "total_amount_of_mirrors": "mirrors",
    "total_amount_of_collects": "collects",
    "total_amount_of_comments": "comments",
    "total_upvotes": "upvotes",
    "total_downvotes": "downvotes",
}
# ---------------------------------------------------------------- end fixed values

# Feature entity "posts" and "profiles" (value types of the feature ids).
POST_FEATURES = _schema(("age", L), ("mirrors", L), ("collects", L), ("comments", L), ("upvotes", L),
                        ("downvotes", L), ("is_original", B), ("language", S), ("region", S),
                        ("is_content_warning", B), ("content_warning", S), ("main_content_focus", S),
                        ("custom_filters_gardener_flagged", B), ("recommend", S), ("profile_id", S))
PROFILE_FEATURES = _schema(("followship_score", D), ("followship_rank", L))

FEED = _schema(("strategy_name", S), ("post_id", S), ("v", D))


def enforce(df: DataFrame, schema: StructType, keep_extra: bool = True) -> DataFrame:
    """Cast the columns named in ``schema`` to their types (``try_cast``);
    missing columns are added as typed NULLs, other columns kept or dropped."""
    cols = []
    present = set(df.columns)
    for f in schema.fields:
        if f.name in present:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    if keep_extra:
        named = {f.name for f in schema.fields}
        cols += [F.col(c) for c in df.columns if c not in named]
    return df.select(*cols)
