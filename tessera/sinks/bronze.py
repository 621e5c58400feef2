"""Bronze loading: lineage columns, idempotent date-partition reload,
append with schema evolution, many-table runs with error isolation."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PROCESSING_DATE = "_processing_date"


def with_bronze_metadata(df: DataFrame, processing_date: str, source_file: bool = False) -> DataFrame:
    """Add the bronze lineage columns: a per-row uuid, the source file (only
    for file scans, from the hidden ``_metadata`` column), the ingestion
    time and the processing date as a DATE (not a string: a string literal
    is read back from partition directories as a date anyway)."""
    cols = {
        "_row_id": F.expr("uuid()"),
        "_ingested_at": F.current_timestamp(),
        PROCESSING_DATE: F.lit(processing_date).cast("date"),
    }
    if source_file:
        cols["_source_file"] = F.col("_metadata.file_path")
    return df.withColumns(cols)


def drop_partition(spark: SparkSession, path: str, partition_col: str, value: str) -> None:
    """Remove one partition directory of a table, if it is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{partition_col}={value}")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(target):
        fs.delete(target, True)


def reload_partition(df: DataFrame, path: str, partition_col: str = PROCESSING_DATE,
                     fmt: str = "parquet", day: str | None = None) -> None:
    """Idempotent load of the partitions present in ``df``.

    With dynamic partition overwrite, only the partitions that ``df``
    contains are replaced and the others stay; the first run creates the
    table.  The new files are complete before the commit deletes the old
    ones and renames; a crash in between is mended by running the load
    again.  An empty ``df`` names no partition, so give the ``day`` that the
    load is for: its rows then go, as delete-then-append would have it."""
    if day is not None and not df.take(1):  # all columns: raw JSON refuses a bare count
        drop_partition(df.sparkSession, path, partition_col, day)
        return
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).format(fmt)
    (w.option("compression", "zstd") if fmt == "parquet" else w).save(path)


def append_evolving(df: DataFrame, path: str, partition_col: str | None = PROCESSING_DATE,
                    fmt: str = "parquet") -> None:
    """Append with new columns allowed; readers merge the file schemas."""
    w = df.write.mode("append").format(fmt)
    if partition_col:
        w = w.partitionBy(partition_col)
    w.save(path)


def read_evolving(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a table whose files carry different (additive) schemas."""
    return spark.read.format(fmt).option("mergeSchema", "true").load(path)


RESULT_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("error", T.StringType()),
])


def run_tables(spark: SparkSession, tables: list[str],
               load_one: Callable[[str], int], at_once: int = 1) -> DataFrame:
    """Run ``load_one(table) -> rows written`` for every table, ``at_once``
    of them at a time; one failure does not stop the others.  Returns (table,
    status, rows, error).  The loop is over table names only; each load is a
    distributed job, in a job group and a scheduler pool named after its
    table, so that under FAIR scheduling a small table needn't wait for a
    large one."""
    def load(name: str) -> tuple:
        context = spark.sparkContext
        context.setJobGroup(f"bronze {name}", f"load of {name}")
        context.setLocalProperty("spark.scheduler.pool", name)
        try:
            return name, "SUCCESS", int(load_one(name)), None
        except Exception as exc:  # isolate the failing table
            return name, "FAILED", None, f"{type(exc).__name__}: {exc}"
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
            context.setLocalProperty("spark.scheduler.pool", None)

    if at_once == 1:
        return spark.createDataFrame([load(t) for t in tables], RESULT_SCHEMA)
    with ThreadPoolExecutor(at_once) as pool:
        # wrapped once per table: a wrapped function's calls share their properties
        results = [f.result() for f in [pool.submit(inheritable_thread_target(spark)(load), t) for t in tables]]
    return spark.createDataFrame(results, RESULT_SCHEMA)
