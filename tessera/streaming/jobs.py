"""Structured Streaming jobs: file-source ingestion with checkpoints,
time-partitioned file sinks, streaming dedup of re-polled feeds, session
windows and keyed upserts through ``foreachBatch``.

Triggers: ``processing_time`` ("60 seconds") for continuous polling, or
``available_now`` to drain what is there and stop (backfills, tests).
Checkpoints and sinks live under the shared checkpoint folder, so a job
restarted after a failure (or an executor loss) resumes exactly where the
committed offsets say.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.time import hour_parts
from tessera.operators.dedup import latest_per_key
from tessera.sinks import versioned
from tessera.sinks.files import GZIP, HOUR_COLS, TIMESTAMP_OPTIONS
from tessera.sources.files import TIMESTAMP_OPTIONS as READ_TS_OPTIONS


HOUR_TASKS = 8
BACKLOG_BATCHES = 4


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Incremental file source: each file is read once; progress is kept in
    the query checkpoint (a rerun adds nothing)."""
    r = spark.readStream.format(fmt).schema(schema)
    if fmt == "json":
        r = r.options(**READ_TS_OPTIONS)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def files_per_batch(spark: SparkSession, path: str, least: int, batches: int = BACKLOG_BATCHES) -> int:
    """``max_files_per_trigger`` for a backlog: ``least`` files, or as many as
    drain the files under ``path`` in ``batches`` micro-batches.  What a batch
    costs besides its rows (its commit, a state store's partitions, the
    buckets of a target that it rewrites) is then paid a fixed number of times,
    not once per ``least`` files.  The driver sees the listing only."""
    _, folder, fs = _listing(spark, path)
    files = fs.getContentSummary(folder).getFileCount() if fs.exists(folder) else 0
    return max(least, -(-files // batches))


def _trigger(writer, processing_time: str | None):
    return writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)


STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def run(writer, processing_time: str | None = None, timeout_s: int | None = None, spark: SparkSession | None = None):
    """Start a configured writer; with no processing time, drain the input
    (availableNow) and wait for it to finish.  With ``spark``, the query's
    state is kept in RocksDB on the executors' disks instead of their heaps
    (a query takes the session's settings as they are when it starts)."""
    before = {k: spark.conf.get(k, None) for k in STATE_ON_DISK} if spark else {}
    try:
        for k in before:
            spark.conf.set(k, STATE_ON_DISK[k])
        q = _trigger(writer, processing_time).start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    if processing_time is None:
        q.awaitTermination(timeout_s)
    return q


def drop_tombstones(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Null-valued messages (tombstones) are ignored by the sink policy."""
    return df.where(F.col(value_col).isNotNull())


def hour_partitioned_sink(df: DataFrame, ts_col: str, path: str, checkpoint: str,
                          max_records_per_file: int = 100):
    """Append to year=/month=/day=/hour= directories of the event time,
    rolling files at ``max_records_per_file`` rows (time rotation is the
    trigger interval).  Late rows go to their own hour: nothing is dropped.
    Each hour's rows go to ``HOUR_TASKS`` tasks by a hash of the row, so one
    timestamp shared by a whole batch is not one task."""
    parts = df.withColumns(hour_parts(ts_col)).repartition(
        *HOUR_COLS, F.pmod(F.xxhash64(*df.columns), F.lit(HOUR_TASKS)))
    return (parts.writeStream.format("json").options(**TIMESTAMP_OPTIONS).outputMode("append")
            .option("maxRecordsPerFile", max_records_per_file).partitionBy(*HOUR_COLS)
            .option("checkpointLocation", checkpoint).option("path", path))


def parquet_sink(df: DataFrame, path: str, checkpoint: str):
    """Exactly-once file sink (the sink log commits each batch once)."""
    return (df.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).option("path", path))


def dedup_within_watermark(df: DataFrame, keys: list[str], time_col: str, delay: str) -> DataFrame:
    """Drop repeats of ``keys`` arriving within ``delay`` of the first copy
    (e.g. the same row re-published by every bulk poll).  State per key is
    dropped once the watermark passes, so it stays bounded."""
    return df.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(keys)


def session_counts(df: DataFrame, user_col: str, time_col: str, gap: str, delay: str) -> DataFrame:
    """Per user session windows (gap-based) with event counts."""
    return (df.withWatermark(time_col, delay)
            .groupBy(F.col(user_col), F.session_window(F.col(time_col), gap).alias("session"))
            .agg(F.count(F.lit(1)).alias("events"), F.min(time_col).alias("first_ts"),
                 F.max(time_col).alias("last_ts")))


def closed_sessions(df: DataFrame, user_col: str, time_col: str, gap: str, delay: str, closing) -> DataFrame:
    """``session_counts`` for append mode: a session comes out once, when the
    watermark has passed its end, and its state goes.  A record at the time
    ``closing`` (later than all events) ends the feed: it moves the watermark
    over every session and is no event itself.  Its filter names the time
    column, so it stays above the watermark."""
    marked = df.withWatermark(time_col, delay).where(F.col(time_col) < F.lit(closing))
    return (marked.groupBy(F.col(user_col), F.session_window(F.col(time_col), gap).alias("session"))
            .agg(F.count(F.lit(1)).alias("events"), F.min(time_col).alias("first_ts"), F.max(time_col).alias("last_ts"))
            .drop("session"))


def progress_of(query) -> dict[str, int]:
    """State rows left after a drained query, and rows it dropped as late."""
    steps = [p["stateOperators"] for p in query.recentProgress if p["stateOperators"]]
    return {"state_rows": sum(s["numRowsTotal"] for s in steps[-1]) if steps else 0,
            "late_rows": sum(s["numRowsDroppedByWatermark"] for ops in steps for s in ops)}


FAN_OUT_EVERY = "300 seconds"


def fan_out(messages: DataFrame, folder: Column, path: str, checkpoint: str, max_records_per_file: int = 1000):
    """A configured writer that files each message under its topic's folder:
    one query for all topics, tombstones left out, JSON files of at most
    ``max_records_per_file`` messages.  Below a topic's folder each batch has
    its own, which a repeated batch replaces.  Run it every
    ``FAN_OUT_EVERY`` (``run(writer, FAN_OUT_EVERY)``), or drained."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .options(**GZIP).option("maxRecordsPerFile", max_records_per_file).partitionBy("sink_folder", "_batch").json(path))
    return (drop_tombstones(messages).withColumn("sink_folder", folder).writeStream
            .option("checkpointLocation", checkpoint).foreachBatch(write))


def overwrite_each_batch(path: str):
    """foreachBatch body for complete-mode results: each batch writes a
    version of its own, the newest complete one is the table
    (``current_version``), and older ones but the last are dropped."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/v={batch_id}")
        expire_versions(batch.sparkSession, path, keep=2)
    return write


def upsert_versions(root: str, keys: list[str], order_by: list[str], op_col: str | None = None, name: str = "batch", keep: int = 3, **how):
    """foreachBatch body that upserts each batch into a versioned table: one
    atomic commit per batch with its number, so that a repeated batch does
    nothing; buckets grow with the table and markers of deleted keys go after
    a number of versions (``versioned.stage_upsert``)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        versioned.upsert(batch, root, keys, order_by, op_col, mark=(name, batch_id), **how)
        versioned.expire(batch.sparkSession, root, keep)
    return write


DELETED = "__deleted"
UPSERT_BUCKETS = 16


def upsert_each_batch(target_root: str, keys: list[str], order_by: list[str], op_col: str | None = None,
                      buckets: int = UPSERT_BUCKETS, keep: int = 3):
    """foreachBatch body keeping the latest row per key.

    The target is split in hash buckets of the key.  Version ``v=<batch_id>``
    holds only the buckets that the batch touches, each rebuilt from its
    newest earlier version and the batch; all other buckets stay where they
    are.  A job never overwrites what it reads, and a retried batch rewrites
    its own version.  With ``op_col``, a key whose latest change is 'd' stays
    as a marked row, so a late older change can't bring it back;
    ``read_target`` leaves marked rows out.  The batch is computed once
    (persisted), and bucket versions beyond the newest ``keep`` expire."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        deleted = F.coalesce(F.col(op_col) == "d", F.lit(False)) if op_col else F.lit(False)
        rows = batch.withColumn(DELETED, deleted)
        rows = (rows.drop(op_col) if op_col else rows).withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        changes = latest_per_key(rows, keys, order_by).persist()
        try:
            touched = {r[0] for r in changes.select("_bucket").distinct().collect()}  # at most ``buckets``
            old = [path for b, path in bucket_paths(spark, target_root, below=batch_id).items() if b in touched]
            if old:
                state = spark.read.schema(changes.drop("_bucket").schema).parquet(*old) \
                    .withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
                changes_and_state = latest_per_key(changes.unionByName(state), keys, order_by)
            else:
                changes_and_state = changes
            changes_and_state.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_bucket").parquet(f"{target_root}/v={batch_id}")
        finally:
            changes.unpersist()
        expire_versions(spark, target_root, keep, per_bucket=True)
    return write


def read_target(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The live rows of an upsert target (``schema``: its data columns)."""
    paths = list(bucket_paths(spark, root).values())
    full = T.StructType(schema.fields + [T.StructField(DELETED, T.BooleanType())])
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(full).parquet(*paths).where(~F.col(DELETED)).drop(DELETED)


def _listing(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    return jvm, path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions, ascending (directory names only)."""
    jvm, path, fs = _listing(spark, root)
    if not fs.exists(path):
        return []
    found = [st.getPath() for st in fs.listStatus(path) if st.isDirectory() and st.getPath().getName().startswith("v=")]
    return sorted(int(p.getName()[2:]) for p in found if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def bucket_paths(spark: SparkSession, root: str, below: int | None = None) -> dict[int, str]:
    """bucket -> its newest committed directory."""
    jvm, _, fs = _listing(spark, root)
    out: dict[int, str] = {}
    for v in _versions(spark, root):
        if below is None or v < below:
            for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/v={v}")):
                name = st.getPath().getName()
                if name.startswith("_bucket="):
                    out[int(name[8:])] = f"{root.rstrip('/')}/v={v}/{name}"
    return out


def current_version(spark: SparkSession, root: str) -> str | None:
    """Path of the newest committed version directory (listing only)."""
    versions = _versions(spark, root)
    return f"{root.rstrip('/')}/v={versions[-1]}" if versions else None


def expire_versions(spark: SparkSession, root: str, keep: int, per_bucket: bool = False) -> None:
    """Delete versions (with ``per_bucket``: a bucket's directories) but the
    newest ``keep``; readers that started on an older one may finish."""
    jvm, _, fs = _listing(spark, root)
    versions = _versions(spark, root)
    if not per_bucket:
        for v in versions[:-keep]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/v={v}"), True)
        return
    seen: dict[str, int] = {}
    for v in reversed(versions):
        for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/v={v}")):
            name = st.getPath().getName()
            if name.startswith("_bucket="):
                seen[name] = seen.get(name, 0) + 1
                if seen[name] > keep:
                    fs.delete(st.getPath(), True)
