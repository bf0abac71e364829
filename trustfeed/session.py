"""Session helpers.

The library never creates a global session; callers pass one in. These helpers
only build a session for tests/bench and make sure a reliable checkpoint folder
exists (read from the cluster config first, set locally only when absent).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock for day/second arithmetic, AQE
# for runtime coalescing and skew-join splitting.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Arrow batches of texts by bytes: 10,000 whole texts at once, in the JVM and in Python, would be a batch of any size.
TEXT_CONF = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "trustfeed", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in {**CORE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_core_conf(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    for k, v in CORE_CONF.items():
        spark.conf.set(k, v)


def apply_text_conf(spark: SparkSession) -> None:
    """Bounds the text batches of the session's jobs, unless the session has a bound of its own."""
    for k, v in TEXT_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster this is ``spark.checkpoint.dir`` (or the directory already set
    on the SparkContext); without one the call fails, since executors could not
    see a folder of the driver. In a one-process local session a fresh scratch
    folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="trustfeed-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder (for written tables)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{os.getpid()}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str = "stage"):
    """Write ``df`` once as Parquet below the shared checkpoint folder and
    continue from the written table.

    Used at stage boundaries (scored features, bounded samples, numbered
    rows) so that later steps that read a result more than once do not
    recompute its lineage, and a lost executor does not send the job back to
    the sources. The written table is read back with the known schema (no
    inference job), and later scans get column pruning, filter pushdown and
    real size statistics. One pass: unlike an eager ``checkpoint()`` of an
    unpersisted Dataset, nothing is computed twice. Never node-local storage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> bool:
    """Delete a table folder that this library wrote, in whatever store it lies; false if there was none."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
