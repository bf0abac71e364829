"""Feature intervals against a plain as-of lookup."""

import random

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from trustfeed.operators.validity import FROM, INGEST, OPEN, TO, FeatureIntervals

FIELDS = [StructField("v", LongType()), StructField("w", StringType())]
DAYS = [f"2024-01-0{d} 00:00:00" for d in range(1, 8)]


def _ingest(spark, table, history, day, rows):
    history[day] = rows
    df = spark.createDataFrame([(e, v, w) for e, (v, w) in rows.items()], "entity_id string, v bigint, w string")
    table.ingest(df, day)


def _plain(history, entity, t, start=""):
    days = [d for d in sorted(history) if start <= d <= t and entity in history[d]]
    return history[days[-1]][entity] if days else (None, None)


def _check(spark, table, history, start=None):
    asked = [(i, random.choice(["a", "b", "c", "d", "hot", None]), random.choice(DAYS)) for i in range(60)]
    df = spark.createDataFrame(asked, "i int, e string, t string").withColumn("t", F.col("t").cast("timestamp"))
    got = {r["i"]: (r["v"], r["w"]) for r in table.lookup(df, "e", "t", start).collect()}
    assert got == {i: _plain(history, e, t, start or "") for i, e, t in asked}


def test_ingests_in_order_late_and_again(spark):
    random.seed(1)
    table, history = FeatureIntervals(spark, FIELDS, buckets=4), {}

    def some():
        return {e: (random.randrange(9), None if random.random() < 0.3 else "x") for e in random.sample("abcd", 2) + ["hot"]}
    for day in (DAYS[0], DAYS[2], DAYS[4]):
        _ingest(spark, table, history, day, some())
    _check(spark, table, history)
    before = table.rows().where(F.col(INGEST).startswith("20240103")).inputFiles()
    _ingest(spark, table, history, DAYS[5], some())
    assert table.rows().where(F.col(INGEST).startswith("20240103")).inputFiles() == before     # older history untouched
    _ingest(spark, table, history, DAYS[1], some())             # late
    _ingest(spark, table, history, DAYS[5], {"a": (5, "again")})        # again, with other rows
    _check(spark, table, history)
    _check(spark, table, history, DAYS[2])
    rows = table.rows().collect()
    assert len({(r["entity_id"], r[FROM]) for r in rows}) == len(rows) == sum(map(len, history.values()))
    assert all((r[TO] is None) == (r[INGEST] == OPEN) for r in rows)
    got = {r["entity_id"]: (r["v"], r["w"]) for r in table.at(DAYS[3]).collect()}
    assert got == {e: _plain(history, e, DAYS[3]) for e in {e for d in history if d <= DAYS[3] for e in history[d]}}
    table.drop()


def test_empty_nulls_and_repeats(spark):
    table = FeatureIntervals(spark, FIELDS, buckets=4)
    empty = spark.createDataFrame([], "entity_id string, v bigint, w string")
    table.ingest(empty, DAYS[0])
    assert table.rows().count() == 0
    table.ingest(spark.createDataFrame([(None, 1, "n"), ("a", 1, "x"), ("a", 1, "x")], empty.schema), DAYS[0])
    table.ingest(empty, DAYS[1])
    assert [(r["entity_id"], r[TO]) for r in table.rows().collect()] == [("a", None)]
    table.ingest(empty, DAYS[0])        # its rows are replaced by none
    assert table.rows().count() == 0
    table.drop()


def test_lookup_reads_the_table_without_a_shuffle(spark):
    table = FeatureIntervals(spark, FIELDS, buckets=8)
    table.ingest(spark.range(2000).select(F.col("id").cast("string").alias("entity_id"), F.col("id").alias("v"),
                                          F.lit("x").alias("w")), DAYS[0])
    asked = spark.range(500).select(F.col("id").cast("string").alias("_tf_e"), F.lit(DAYS[1]).cast("timestamp").alias("_tf_t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = table.versions_at(asked)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the one exchange is that of the keys
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan, plan
    table.drop()
