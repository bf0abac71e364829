"""Table readers of the source systems.

Each returns a lazy DataFrame; filters and projections applied afterwards are
pushed to the source by Spark (Parquet row-group/column pruning, JDBC
``WHERE`` clauses).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A single file or a partition tree; an explicit schema skips the
    footer inference job."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_source(spark: SparkSession, fmt: str, table: str | None = None, query: str | None = None,
                options: dict | None = None) -> DataFrame:
    """A5: any DataSource by table name or by query text.

    The warehouse connector of the deployment is named by ``fmt`` and takes
    either ``table`` or ``query`` (plus connector options); with
    ``fmt="parquet"`` the table is a path.
    """
    reader = spark.read.format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if query is not None:
        return reader.option("query", query).load()
    if fmt in ("parquet", "orc", "json", "csv"):
        return reader.load(table)
    return reader.option("table", table).load()


def read_jdbc(spark: SparkSession, url: str, query: str | None = None, table: str | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, properties: dict | None = None,
              fetch_size: int = 10000) -> DataFrame:
    """A JDBC table or query, read in parallel ranges.

    With ``partition_column`` and bounds, Spark issues ``num_partitions``
    range queries instead of streaming the whole result through one
    connection. Needs the database's JDBC driver on the classpath.
    """
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if query is not None and partition_column is None:
        reader = reader.option("query", query)
    else:
        # partitioned reads need a table expression; wrap the query as one
        src = table if table is not None else f"({query}) AS src"
        reader = reader.option("dbtable", src)
    if partition_column is not None:
        reader = reader.option("partitionColumn", partition_column) \
            .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound)) \
            .option("numPartitions", str(num_partitions or 8))
    return reader.load()
