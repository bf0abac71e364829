"""Run ledger: exactly-once increments and a manifest of runs.

A run writes its rows to a directory of its own and then appends one record to the ledger, a small Parquet table: the
run, its directory, the cursor it started after, the least and greatest cursor value that it holds, and its rows. The
append of the record (one file, so one rename) is the commit of data and cursor together: without it the directory
counts for nothing, and the next run, under whatever id, starts from the same cursor again. Readers ask the ledger which
directories there are, so they neither see what a crashed run left behind nor list the storage.

As every record holds its run's range, a read opens only the runs that it needs, and small runs can be rewritten as one
(``compact_runs``): that is a record that replaces others. One writer at a time, as a scheduler guarantees; readers at any time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from trustfeed.params import DEFAULT_EXTRACT_WATERMARK
from trustfeed.session import drop_path
from trustfeed.sources.increments import has_rows, read_if_written, write_snapshot

# ``first_run`` to ``last_run``: the runs whose rows the directory holds; ``replaces``: the records that it stands for.
RECORD = ("run bigint, path string, rows bigint, after string, low string, high string, first_run bigint, last_run bigint, "
          "replaces array<bigint>")


def records(spark: SparkSession, ledger: str) -> DataFrame:
    """All committed records, also replaced ones."""
    table = read_if_written(spark, ledger)
    return spark.createDataFrame([], RECORD) if table is None else spark.read.schema(RECORD).parquet(ledger)


def live_records(spark: SparkSession, ledger: str) -> list[Row]:
    """The records that no other replaces, by run. One per run, so a list of them is short."""
    every = records(spark, ledger).collect()
    replaced = {r for x in every for r in x["replaces"] or ()}
    return sorted((r for r in every if r["run"] not in replaced), key=lambda r: r["first_run"])


def ledger_cursor(spark: SparkSession, ledger: str, default, dtype: str = "timestamp"):
    """A3: the greatest cursor value of all committed runs, or ``default`` before the first."""
    row = records(spark, ledger).agg(F.max(F.col("high").cast(dtype)).alias("high")).first()
    return default if row["high"] is None else row["high"]


def append_record(spark: SparkSession, ledger: str, run: int, path: str, rows: int | None = None, after=None, low=None, high=None,
                  first_run: int | None = None, last_run: int | None = None, replaces: list[int] | None = None) -> None:
    """The commit of a run."""
    text = [None if v is None else str(v) for v in (after, low, high)]
    record = (int(run), path, rows, *text, first_run or int(run), last_run or int(run), replaces or [])
    spark.createDataFrame([record], RECORD).coalesce(1).write.mode("append").parquet(ledger)


def range_of(df: DataFrame, col: str) -> Row:
    """rows, low and high of a written run, the bounds as text."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.min(col).cast("string").alias("low"), F.max(col).cast("string").alias("high")).first()


def ingest_run(spark: SparkSession, source: DataFrame, root: str, ledger: str, run: int, cursor_col: str = "block_timestamp",
               initial=DEFAULT_EXTRACT_WATERMARK) -> str | None:
    """The rows past the ledger's cursor as run ``run``, committed with the next cursor.

    Returns the run's directory; None if nothing is new, which leaves no record. A run that is committed already is left as it
    is, whatever the source holds by now. Rows whose cursor is null are never new.
    """
    done = {r["run"]: r["path"] for r in records(spark, ledger).select("run", "path").collect()}
    if int(run) in done:
        return done[int(run)]
    dtype = source.schema[cursor_col].dataType.simpleString()
    after = ledger_cursor(spark, ledger, initial, dtype)
    new = source.where(F.col(cursor_col) > F.lit(after).cast(dtype))
    if not has_rows(new):
        return None
    path = write_snapshot(new, root, run)
    # of what was written, not of the source, which may have grown meanwhile
    held = range_of(spark.read.parquet(path), cursor_col)
    append_record(spark, ledger, run, path, held["rows"], after, held["low"], held["high"])
    return path


def needed(live: list[Row], after_run: int | None = None, low=None, high=None, dtype=str) -> list[Row]:
    """The records that may hold rows of runs past ``after_run`` with cursor values in (low, high]."""
    def fits(r: Row) -> bool:
        if after_run is not None and r["last_run"] <= after_run:
            return False
        if r["high"] is None:
            return True
        return not (low is not None and dtype(r["high"]) <= dtype(low) or high is not None and dtype(r["low"]) > dtype(high))
    return [r for r in live if fits(r)]


def read_runs(spark: SparkSession, root: str, ledger: str, after_run: int | None = None, low=None, high=None, dtype=str,
              schema=None) -> DataFrame:
    """A4: the rows of committed runs past ``after_run`` with ``dtime``, from the directories that are needed only.

    ``low`` and ``high`` (a cursor range, compared as ``dtype``) leave out runs, not single rows. ``schema`` is that of the
    rows without ``dtime``; it has to be given where there may be no run yet.
    """
    return _rows_of(spark, root, needed(live_records(spark, ledger), after_run, low, high, dtype), after_run, schema)


def _rows_of(spark: SparkSession, root: str, chosen: list[Row], after_run: int | None, schema) -> DataFrame:
    if schema is not None:
        schema = spark.createDataFrame([], schema).withColumn("dtime", F.lit(0).cast("bigint")).schema
    if not chosen:
        if schema is None:
            raise ValueError("no run to read: give the schema of the rows")
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    # a single run's id is in its directory's name, those of runs that were put together are in the rows
    single = [r["path"] for r in chosen if not r["replaces"]]
    merged = [r["path"] for r in chosen if r["replaces"]]
    parts = [reader.parquet(*merged)] if merged else []
    if single:
        parts.append(reader.option("basePath", root.rstrip("/")).parquet(*single))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    rows = rows.withColumn("dtime", F.col("dtime").cast("bigint"))
    return rows if after_run is None else rows.where(F.col("dtime") > after_run)


def compact_runs(spark: SparkSession, root: str, ledger: str, below_rows: int, target_rows: int) -> list[str]:
    """Rewrite neighbouring runs of fewer than ``below_rows`` rows as directories of up to ``target_rows``; returns these.

    The rows keep their run in ``dtime``. A crash leaves a directory that no record names; the old runs stay readable until
    ``drop_replaced``.
    """
    groups, group = [], []
    for r in live_records(spark, ledger):
        small = r["rows"] is not None and r["rows"] < below_rows
        if not small or sum(x["rows"] for x in group) + r["rows"] > target_rows:
            groups.append(group)
            group = []
        if small:
            group.append(r)
    paths = []
    for group in [g for g in [*groups, group] if len(g) > 1]:
        first, last = group[0]["first_run"], group[-1]["last_run"]
        path = f"{root.rstrip('/')}/_compacted/runs-{first}-{last}"
        _rows_of(spark, root, group, None, None).coalesce(1).write.mode("overwrite").parquet(path)
        # an id of its own, which no run has
        own = min(r["run"] for r in records(spark, ledger).select("run").collect())
        append_record(spark, ledger, min(own, 0) - 1, path, sum(r["rows"] for r in group), group[0]["after"], group[0]["low"],
                      group[-1]["high"], first, last, [r["run"] for r in group])
        paths.append(path)
    return paths


def drop_replaced(spark: SparkSession, ledger: str) -> None:
    """Delete the directories of replaced runs; to be called when no reader holds an older list of runs."""
    every = records(spark, ledger).collect()
    replaced = {r for x in every for r in x["replaces"] or ()}
    for r in every:
        if r["run"] in replaced:
            drop_path(spark, r["path"])

