"""Reference-shaped source tables derived from the driver's Parquet tables.

The social-network source tables (profiles, trust snapshots, posts, stats,
follow/collect/comment events, collect modules) are not shipped as data; the
mapping in FIXTURES.md derives them from the generic tables. Each builder is a
lazy DataFrame over a pruned Parquet scan, so the work grows with the inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustfeed.params import MATIC_CONTRACT


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _hex_id(c) -> F.Column:
    return F.concat(F.lit("0x"), c.cast("string"))


def _post_id(cust, order) -> F.Column:
    return F.concat(F.lit("0x"), cust.cast("string"), F.lit("-0x"), order.cast("string"))


class SourceTables:
    """Lazy accessors for the source tables of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        # one reader per table: the footer/schema job runs once per table
        if name not in self._raw:
            self._raw[name] = read_table(self.spark, self.sf_dir, name)
        return self._raw[name]

    # profile(profile_id, handle, owned_by, profile_picture_s3_url, metadata_block_timestamp)
    def profile(self) -> DataFrame:
        c = self.raw("customer")
        k = F.col("c_custkey")
        owner = F.when(k % 10 == 1, k - 1).otherwise(k)
        return c.select(
            _hex_id(k).alias("profile_id"),
            F.col("c_name").alias("handle"),
            F.concat(F.lit("w"), owner.cast("string")).alias("owned_by"),
            F.concat(F.lit("s3://img/"), k.cast("string")).alias("profile_picture_s3_url"),
            F.lit("2022-05-01 00:00:00").cast("timestamp").alias("metadata_block_timestamp"),
        )

    # globaltrust(strategy_name, i, v, date): two followship snapshots, one engagement
    def globaltrust(self) -> DataFrame:
        c = self.raw("customer").select("c_custkey", "c_acctbal")
        k = F.col("c_custkey")
        bal = (F.col("c_acctbal") + F.lit(1000.0)) / F.lit(11000.0)
        newest = c.where(k % 5 != 4).select(
            F.lit("followship").alias("strategy_name"), _hex_id(k).alias("i"),
            bal.alias("v"), F.lit("2024-01-08").cast("date").alias("date"))
        older = c.select(
            F.lit("followship").alias("strategy_name"), _hex_id(k).alias("i"),
            (F.lit(1.0) - bal).alias("v"), F.lit("2024-01-01").cast("date").alias("date"))
        other = c.select(
            F.lit("engagement").alias("strategy_name"), _hex_id(k).alias("i"),
            F.lit(0.5).alias("v"), F.lit("2024-02-01").cast("date").alias("date"))
        return newest.unionByName(older).unionByName(other)

    def profile_post(self) -> DataFrame:
        o = self.raw("orders")
        key, cust = F.col("o_orderkey"), F.col("o_custkey")
        related = F.concat(F.lit("0x"), (cust % 50).cast("string"), F.lit("-0x"),
                           (key % 1000).cast("string"))
        partial = F.col("o_orderstatus") == "P"
        return o.select(
            _post_id(cust, key).alias("post_id"),
            _hex_id(cust).alias("profile_id"),
            _hex_id(key).alias("contract_publication_id"),
            F.when(partial & (key % 3 == 0), related).alias("is_related_to_post"),
            F.when(partial & (key % 3 == 1), related).alias("is_related_to_comment"),
            F.when(key % 11 == 0, "true").otherwise("false").alias("is_hidden"),
            F.when(key % 13 == 0, "true").otherwise("false").alias("is_gated"),
            F.col("o_orderdate").alias("block_timestamp"),
            F.when(key % 4 == 0, "es").when(key % 4 == 1, "de").otherwise("en").alias("language"),
            F.when(key % 5 != 0, "US").alias("region"),
            F.when(F.col("o_orderpriority") == "1-URGENT", "NSFW").alias("content_warning"),
            F.when(key % 3 == 0, "IMAGE").when(key % 3 == 1, "VIDEO").otherwise("TEXT_ONLY")
            .alias("main_content_focus"),
            F.col("o_orderpriority").alias("tags_vector"),
            F.when(key % 17 == 0, "true").when(key % 17 == 1, F.lit(None)).otherwise("false")
            .alias("custom_filters_gardener_flagged"),
            F.concat(F.lit("ipfs://"), key.cast("string")).alias("content_uri"),
        )

    def publication_stats(self) -> DataFrame:
        """Counters per post.

        Line items are pre-aggregated per order before the join (map-side partial
        aggregation), so only one row per order is shuffled and joined; the join
        output is already clustered by the order key, which the final grouping
        reuses without another exchange.
        """
        li = self.raw("lineitem")

        def cnt(cond):
            return F.sum(F.when(cond, 1).otherwise(0))

        per_order = li.groupBy("l_orderkey").agg(
            cnt(F.col("l_returnflag") == "R").alias("m"),
            cnt(F.col("l_returnflag") == "A").alias("c"),
            cnt(F.col("l_returnflag") == "N").alias("n"),
            cnt(F.col("l_quantity") > 25).alias("u"),
            cnt(F.col("l_linestatus") == "O").alias("d"),
        )
        o = self.raw("orders").select("o_orderkey", "o_custkey")
        j = per_order.join(o, per_order.l_orderkey == o.o_orderkey, "inner")
        return j.groupBy("o_custkey", "o_orderkey").agg(
            F.sum("m").cast("bigint").alias("total_amount_of_mirrors"),
            F.sum("c").cast("bigint").alias("total_amount_of_collects"),
            F.sum("n").cast("bigint").alias("total_amount_of_comments"),
            F.sum("u").cast("bigint").alias("total_upvotes"),
            F.sum("d").cast("bigint").alias("total_downvotes"),
        ).select(
            _post_id(F.col("o_custkey"), F.col("o_orderkey")).alias("publication_id"),
            "total_amount_of_mirrors", "total_amount_of_collects", "total_amount_of_comments",
            "total_upvotes", "total_downvotes",
            F.lit("x").alias("datastream_metadata"),
        )

    def follower(self) -> DataFrame:
        e = self.raw("events").where(F.col("event_type") == "signup")
        return e.select(
            F.concat(F.lit("w"), F.col("user_id").cast("string")).alias("address"),
            _hex_id(F.col("event_id") % 150).alias("follow_profile_id"),
            F.col("ts").alias("block_timestamp"),
        )

    def collected_records(self) -> DataFrame:
        e = self.raw("events").where(F.col("event_type") == "purchase")
        return e.select(
            F.col("event_id").alias("record_id"),
            _post_id(F.col("user_id"), F.col("event_id")).alias("publication_id"),
            (F.col("event_id") % 9).cast("string").alias("collect_publication_nft_id"),
            F.concat(F.lit("w"), (F.col("event_id") % 150).cast("string")).alias("collected_by"),
            F.col("ts").alias("block_timestamp"),
        )

    def post_comment(self) -> DataFrame:
        c = self.raw("conversations").select("conv_id", "turn")
        conv, turn = F.col("conv_id"), F.col("turn")
        return c.select(
            _post_id(conv, turn).alias("comment_id"),
            _hex_id(conv % 40).alias("comment_by_profile_id"),
            _hex_id(turn).alias("contract_publication_id"),
            _post_id(conv, conv * 3).alias("post_id"),
            F.concat(F.lit("ipfs://c"), conv.cast("string")).alias("content_uri"),
            F.lit("2024-01-01 00:00:00").cast("timestamp").alias("block_timestamp"),
        )

    def collect_module_details(self) -> DataFrame:
        li = self.raw("lineitem").select("l_orderkey", "l_linestatus", "l_extendedprice", "l_returnflag")
        o = self.raw("orders").select("o_orderkey", "o_custkey")
        j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
        return j.select(
            _post_id(F.col("o_custkey"), F.col("o_orderkey")).alias("publication_id"),
            F.when(F.col("l_linestatus") == "O", F.floor("l_extendedprice").cast("bigint")).alias("amount"),
            F.when(F.col("l_returnflag") == "R", F.lit(MATIC_CONTRACT)).otherwise("0xother").alias("currency"),
        )
