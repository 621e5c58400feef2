"""File sinks: time-partitioned NDJSON landings, JSON snapshots, JSON
arrays, Parquet layers, compaction and retention."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.standardize import strip_prefix
from tessera.functions.time import hour_parts

HOUR_COLS = ["year", "month", "day", "hour"]

# JSON and CSV writers keep only milliseconds of timestamps by default;
# these formats keep the microseconds Spark timestamps carry.
TIMESTAMP_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# Landed JSON text repeats its field names in every row; gzip at its fastest
# level leaves about a tenth.  Readers know it by the file name.  A gzip file
# is read by one task, so files have a bounded number of rows.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
FILE_ROWS = 500_000


def write_hour_partitioned(df: DataFrame, path: str, ts_col: str, max_records_per_file: int = 100,
                           fmt: str = "json", mode: str = "append") -> None:
    """Land rows under year=/month=/day=/hour= of their event time, at most
    ``max_records_per_file`` rows per file.  Late rows land in their own
    (older) hour, never dropped.  Rows are first clustered by hour so each
    task writes few directories (see ``_clustered``)."""
    parts = df.withColumns(hour_parts(ts_col))
    # rows of one batch may share one timestamp: a hash of the row splits them
    (_clustered(parts, HOUR_COLS, [F.col(ts_col), F.xxhash64(*df.columns)]).write.mode(mode).format(fmt).options(**TIMESTAMP_OPTIONS)
     .option("maxRecordsPerFile", max_records_per_file).partitionBy(*HOUR_COLS).save(path))


def _clustered(df: DataFrame, partition_cols: list[str], tie_break: list) -> DataFrame:
    """Cluster rows by output directory with range partitioning on the
    partition columns plus a tie-break inside them.  Unlike hashing on the
    partition columns, which sends a hot directory (say an hour holding a
    third of all rows) to one task, the sampled range bounds split a large
    directory over several tasks; small ones stay in one."""
    return df.repartitionByRange(*[F.col(c) for c in partition_cols], *tie_break)


def write_layer(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    w = df.write.mode(mode).format(fmt)
    if fmt in ("json", "csv"):
        w = w.options(**TIMESTAMP_OPTIONS)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def snapshot_path(root: str, table: str, stamp: str) -> str:
    """``{root}/{table without brz_}/snapshot_ts={stamp}``."""
    name = table[4:] if table.startswith("brz_") else table
    return f"{root.rstrip('/')}/{name}/snapshot_ts={stamp}"


def write_snapshot(df: DataFrame, root: str, table: str, stamp: str) -> str:
    """Full-table JSON snapshot, replacing a snapshot of the same name."""
    path = snapshot_path(root, table, stamp)
    df.write.mode("overwrite").options(**TIMESTAMP_OPTIONS, **GZIP).option("maxRecordsPerFile", FILE_ROWS).json(path)
    return path


def table_name_expr(col) -> F.Column:
    return strip_prefix(col, "brz_")


ARRAY_ROWS = 100_000


def _array_lines(rows: int):
    """Turn a partition's JSON lines into the lines of JSON arrays of ``rows``
    records (the last one fewer; one empty array for an empty partition): '[',
    each record followed by ',' except the last, ']'.  Streams with a
    one-record look-ahead, so memory does not grow with the partition."""
    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pending, held = None, 0  # records of the open array, ``pending`` not yet written
        out = ["["]
        for pdf in batches:
            for v in pdf["j"].tolist():
                if held == rows:
                    out += [pending, "]", "["]
                    held = 0
                elif pending is not None:
                    out.append(pending + ",")
                pending, held = v, held + 1
            yield pd.DataFrame({"value": out})
            out = []
        yield pd.DataFrame({"value": out + ([pending] if pending is not None else []) + ["]"]})
    return lines


def write_json_array_parts(df: DataFrame, path: str, rows: int = ARRAY_ROWS) -> None:
    """Write ``df`` as JSON-array documents (the layout of snapshot uploads),
    for readers that expect multi-line JSON.  Such a file can only be read
    whole, by one task, so a document has at most ``rows`` records: with its
    brackets it fills a file of ``maxRecordsPerFile``, and the next one starts
    the next file."""
    lines = df.select(F.to_json(F.struct("*")).alias("j"))
    (lines.mapInPandas(_array_lines(rows), "value string").write.mode("overwrite").options(**GZIP)
     .option("maxRecordsPerFile", rows + 2).text(path))


def compact(spark: SparkSession, src: str, dst: str, partition_cols: list[str], fmt: str = "json",
            schema=None) -> None:
    """Rewrite a small-file landing into few large files per partition
    directory (one, unless the directory is large enough for the range
    bounds to split it).  Written to a new location: a job must not
    overwrite what it reads."""
    r = spark.read.format(fmt).option("basePath", src).options(**TIMESTAMP_OPTIONS)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(src)
    data_cols = [c for c in df.columns if c not in partition_cols]
    (_clustered(df, partition_cols, [F.xxhash64(*data_cols)]).write.mode("overwrite").format(fmt)
     .options(**TIMESTAMP_OPTIONS).partitionBy(*partition_cols).save(dst))


def drop_partitions_before(spark: SparkSession, base: str, cutoff: str) -> list[str]:
    """Retention for a year=/month=/day= layout: delete day directories
    older than ``cutoff`` ('yyyy-MM-dd').  Only directory listings go
    through the driver (one entry per partition), never rows."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(hconf)
    removed = []

    def children(p):
        return [s.getPath() for s in fs.listStatus(p) if s.isDirectory()]

    for y in children(root):
        if not y.getName().startswith("year="):
            continue
        for m in children(y):
            for d in children(m):
                day = f"{y.getName()[5:]}-{m.getName()[6:]}-{d.getName()[4:]}"
                if day < cutoff:
                    fs.delete(d, True)
                    removed.append(day)
    return sorted(removed)


def landed_files(spark: SparkSession, base: str) -> DataFrame:
    """(path, folder, modified, bytes, day, snapshot) of all files below
    ``base``, listed by Spark; no file is opened.  ``day`` is the date of
    year=/month=/day= folders, ``snapshot`` that of a snapshot_ts= folder."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
             .select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes")))
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    day = F.regexp_extract("path", r"/year=(\d+)/month=(\d+)/day=(\d+)/", 0)
    date = F.regexp_replace(day, r"^/year=(\d+)/month=(\d+)/day=(\d+)/$", "$1-$2-$3")
    stamp = F.regexp_extract("path", r"/snapshot_ts=(\d{4}-?\d{2}-?\d{2})", 1)
    stamp = F.regexp_replace(stamp, r"^(\d{4})-?(\d{2})-?(\d{2})$", "$1-$2-$3")
    return files.withColumns({"folder": folder, "day": F.when(day != "", date).cast("date"), "snapshot": F.when(stamp != "", stamp).cast("date")})


SNAPSHOT_DAYS, STREAM_DAYS = 7, 90


def expired_files(files: DataFrame, today, snapshot_days: int = SNAPSHOT_DAYS, stream_days: int = STREAM_DAYS) -> DataFrame:
    """Files past their age on ``today``: snapshots and streamed hours by the
    date in their path, others by the time they were modified."""
    age = lambda at: F.date_diff(F.lit(today).cast("date"), at)
    return files.where(F.when(F.col("snapshot").isNotNull(), age(F.col("snapshot")) > snapshot_days)
                       .when(F.col("day").isNotNull(), age(F.col("day")) > stream_days)
                       .otherwise(age(F.to_date("modified")) > stream_days))


def retain(spark: SparkSession, base: str, today, snapshot_days: int = SNAPSHOT_DAYS, stream_days: int = STREAM_DAYS) -> int:
    """Delete what is past its age, and return the number of files.  A folder
    whose files all go is deleted whole; the driver handles one name per such
    folder, and one per file only where a folder keeps others."""
    files = landed_files(spark, base).withColumn("gone", F.lit(False))
    old = expired_files(files.drop("gone"), today, snapshot_days, stream_days).select("path", F.lit(True).alias("gone"))
    marked = files.drop("gone").join(old, "path", "left")
    per_folder = marked.groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.count("gone").alias("gone"),
                                              F.collect_list(F.when(F.col("gone"), F.col("path"))).alias("paths"))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    for row in per_folder.where("gone > 0").select("folder", "gone", F.when(F.col("gone") < F.col("files"), F.col("paths")).alias("paths")).toLocalIterator():
        for name in row.paths or [row.folder]:
            target = jvm.org.apache.hadoop.fs.Path(name)
            target.getFileSystem(conf).delete(target, True)
        removed += row.gone
    return removed
