"""Catalog tables: existence probe, partitioned create-or-reload, and SQL
over registered names.

Tables are created *external* (``path`` under the shared folder the
caller names), so their files live where every executor can reach them,
whatever the session's warehouse directory is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.sinks.bronze import PROCESSING_DATE, drop_partition


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def load_partitioned_table(df: DataFrame, name: str, path: str, partition_col: str = PROCESSING_DATE,
                           day: str | None = None) -> str:
    """First run creates ``name`` partitioned by ``partition_col``; later
    runs replace only the partitions present in ``df`` (dynamic partition
    overwrite), so reloading a day is idempotent and other days stay.  An
    empty ``df`` with the ``day`` that it is for empties that day.  Returns
    'created' or 'reloaded'."""
    spark = df.sparkSession
    if not table_exists(spark, name):
        df.write.format("parquet").option("compression", "zstd").partitionBy(partition_col).option("path", path).saveAsTable(name)
        return "created"
    if day is not None and not df.take(1):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({partition_col} = DATE '{day}')")
        drop_partition(spark, path, partition_col, day)
        return "reloaded"
    cols = spark.table(name).columns  # insertInto matches columns by position
    (df.select(*cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .insertInto(name))
    return "reloaded"


def register_views(frames: dict[str, DataFrame]) -> None:
    """Expose frames to ``spark.sql`` under the given names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
