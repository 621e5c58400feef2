"""JDBC scans and appends.

A single-connection JDBC read funnels the whole table through one task;
``read_jdbc`` splits it into ``num_partitions`` range queries on a numeric
or date column (bounds only set the stride, no row is filtered out).  A
projection subquery (``(SELECT ...) AS t``) keeps unneeded columns in the
database.  The driver jar for the database must be on the cluster's class
path; none ships with this repository.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table_or_query: str, properties: dict | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, fetch_size: int = 10_000) -> DataFrame:
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table_or_query) \
        .option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower_bound))
             .option("upperBound", str(upper_bound)).option("numPartitions", num_partitions or 8))
    return r.load()


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
                batch_size: int = 10_000, max_connections: int | None = None) -> None:
    """Append rows in batched inserts; ``max_connections`` caps the writing
    tasks (each holds one connection) by coalescing first."""
    if max_connections:
        df = df.coalesce(max_connections)
    w = df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table) \
        .option("batchsize", batch_size)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
