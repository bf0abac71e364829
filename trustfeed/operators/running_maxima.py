"""Per-author maxima and post scores kept up to date increment by increment.

Maxima merge: an author's maxima over all increments are the maxima of those of each. Every increment stores its own partial maxima,
a row per author it touches, in segments that are merged by powers (``streaming.keyed_state`` says which), and its posts, both in
buckets by author. Posts of an author whose maxima didn't change keep their scores; the posts of the others are read
from their buckets and scored again. So an increment costs what it holds and what it changes, and its written bytes don't grow
with the history.

Every increment writes directories of its own number and reads only those of earlier ones, so one that is run again after a
crash writes the same again. One writer at a time, increments numbered 0, 1, 2, … without gaps.

A post without a rank has no author: it gets no maxima, is scored once, and is spread over the buckets by its key. A post that comes
again replaces its earlier row; maxima cover all its rows (counters never fall). An empty increment changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from trustfeed.operators.scoring import MAX_COLUMNS, with_post_score
from trustfeed.streaming.keyed_state import FANOUT, merges_after, segments_before

BUCKETS = 32
NAMES = tuple(MAX_COLUMNS.values())


class RunningScores:
    """Scores of all posts so far, below ``root``; ``schema`` is that of the posts."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, rank_col: str = "followship_rank", key: str = "post_id",
                 fanout: int = FANOUT, buckets: int = BUCKETS):
        self.spark, self.root, self.rank, self.key = spark, root.rstrip("/"), rank_col, key
        self.fanout, self.buckets = fanout, buckets
        self.columns = schema.fieldNames()
        # written columns may be null, whatever the source says
        parts = StructType().add("bucket", IntegerType()).add("batch", IntegerType())
        self.posts_schema = StructType([*schema.fields, *parts.fields])
        maxima = StructType([schema[rank_col]])
        for source, name in MAX_COLUMNS.items():
            maxima.add(name, schema[source].dataType)
        self.maxima_schema = StructType([*maxima.fields, parts["bucket"]])
        scores = with_post_score(spark.createDataFrame([], StructType([*schema.fields, *maxima.fields[1:]]))).schema
        self.scores_schema = StructType([*scores.fields, parts["batch"]])

    def _bucket(self, of_posts: bool = True):
        author = F.xxhash64(self.rank)
        one = F.when(F.col(self.rank).isNull(), F.xxhash64(self.key)).otherwise(author) if of_posts else author
        return F.pmod(one, F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, path: str, bucketed: bool = True) -> None:
        writer = rows.withColumn("bucket", self._bucket()).write.partitionBy("bucket") if bucketed else rows.write
        writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)

    def _partials(self, segments: list[tuple[int, int]]) -> DataFrame:
        out = self.spark.createDataFrame([], self.maxima_schema)
        for first, last in segments:
            out = out.unionByName(self.spark.read.schema(self.maxima_schema).parquet(f"{self.root}/maxima/segment={first}-{last}"))
        return out

    def _merged(self, partials: DataFrame) -> DataFrame:
        return partials.groupBy(self.rank).agg(*[F.max(c).alias(c) for c in NAMES])

    def _buckets_of(self, authors: DataFrame) -> list[int]:
        return [r["b"] for r in authors.select(self._bucket(of_posts=False).alias("b")).distinct().collect()]      # BUCKETS at most

    def add(self, batch: int, posts: DataFrame) -> DataFrame:
        """Take an increment in; the rows whose score is new or may have changed, as written."""
        own = f"{self.root}/posts/batch={batch}"
        self._write(posts.select(*self.columns), own)
        stored = self.spark.read.schema(self.posts_schema).parquet(f"{self.root}/posts").where(F.col("batch") <= batch)
        mine = stored.where(F.col("batch") == batch)
        segment = f"{self.root}/maxima/segment={batch}-{batch}"
        partial = mine.where(F.col(self.rank).isNotNull()).groupBy(self.rank).agg(*[F.max(s).alias(n) for s, n in MAX_COLUMNS.items()])
        self._write_maxima(partial, segment)
        delta = self.spark.read.schema(self.maxima_schema).parquet(segment)
        touched = self._buckets_of(delta)
        before = self._partials(segments_before(batch, self.fanout)).where(F.col("bucket").isin(touched)) \
            .join(delta.select(self.rank), self.rank, "left_semi").drop("bucket")
        old = self._merged(before).select(self.rank, F.lit(True).alias("_known"), *[F.col(c).alias(f"_old_{c}") for c in NAMES])
        grown = [F.coalesce(F.col(c) > F.col(f"_old_{c}"), F.col(c).isNotNull() & F.col(f"_old_{c}").isNull()) for c in NAMES]
        changed = grown[0]
        for g in grown[1:]:
            changed = changed | g
        now = delta.drop("bucket").join(old, self.rank, "left").withColumn("_changed", F.col("_known").isNull() | changed) \
            .select(self.rank, "_changed", *[F.greatest(c, f"_old_{c}").alias(c) for c in NAMES])
        # written: a side of two joins, one row per author of the increment
        now_path = f"{self.root}/now/batch={batch}"
        schema = now.schema
        self._write(now, now_path, bucketed=False)
        now = self.spark.read.schema(schema).parquet(now_path)
        moved = now.where("_changed").select(self.rank)
        again = stored.where((F.col("batch") < batch) & F.col("bucket").isin(self._buckets_of(moved))).join(moved, self.rank, "left_semi")
        rows = mine.unionByName(again)
        held = [c for c in self.columns if c != self.key]
        newest = rows.groupBy(self.key).agg(F.max_by(F.struct(*held), "batch").alias("_row")) \
            .select(self.key, *[F.col(f"_row.{c}").alias(c) for c in held])
        maxima = now.select(self.rank, *[F.nullif(F.col(c), F.lit(0)).alias(c) for c in NAMES])
        scored = with_post_score(newest.select(*self.columns).join(maxima, self.rank, "left"))
        path = f"{self.root}/scores/batch={batch}"
        self._write(scored, path, bucketed=False)
        for first, last in merges_after(batch, self.fanout):
            size = (last - first + 1) // self.fanout
            parts = self._partials([(s, s + size - 1) for s in range(first, last + 1, size)])
            self._write_maxima(self._merged(parts.drop("bucket")), f"{self.root}/maxima/segment={first}-{last}")
        return self.spark.read.schema(StructType(self.scores_schema.fields[:-1])).parquet(path)

    def _write_maxima(self, maxima: DataFrame, path: str) -> None:
        maxima.withColumn("bucket", self._bucket(of_posts=False)).write.partitionBy("bucket").mode("overwrite") \
            .option("partitionOverwriteMode", "static").parquet(path)

    def current(self) -> DataFrame:
        """Every post with its maxima and score: of each post the row that was written last."""
        rows = self.spark.read.schema(self.scores_schema).parquet(f"{self.root}/scores")
        held = [c for c in rows.columns if c not in (self.key, "batch")]
        return rows.groupBy(self.key).agg(F.max_by(F.struct(*held), "batch").alias("_row")) \
            .select(self.key, *[F.col(f"_row.{c}").alias(c) for c in held])
