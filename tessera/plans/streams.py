"""Streaming plans: each runs a Structured Streaming query to completion
(availableNow) over a landing that Spark writes from the test tables, then
returns the sink's content as a DataFrame."""

from __future__ import annotations

import re
from datetime import timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import time as TM
from tessera.functions import wire
from tessera.functions.standardize import strip_prefix
from tessera.plans import register
from tessera.plans.analytics import LATEST_COLS, SESSION_GAP_SECONDS, _LATEST_SQL, _money_out
from tessera.plans.ingest import EVENT_SCHEMA, _EVENT_SQL, _PARTS_SQL, _events_out
from tessera.plans.lakehouse import TOPIC_PREFIX
from tessera.plans.oracle_star import with_star
from tessera.session import scratch_path
from tessera.sinks import versioned
from tessera.sinks.files import GZIP, TIMESTAMP_OPTIONS, write_hour_partitioned
from tessera.sources import files as SRC
from tessera.sources import incremental, star
from tessera.streaming import evolving
from tessera.streaming import jobs as J


def _flat_landing(spark: SparkSession, df: DataFrame, name: str, rows_per_file: int) -> str:
    """Land ``df`` as flat NDJSON files (the stream's input)."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").options(**TIMESTAMP_OPTIONS, **GZIP).option("maxRecordsPerFile", rows_per_file).json(path)
    return path


@register("stream_hour_sink", f"SELECT {_EVENT_SQL}, {_PARTS_SQL} FROM events")
def stream_hour_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events streamed (a few files per micro-batch) into the hour
    partitioned JSON sink, 100 rows per file; the sink read back whole."""
    src = _flat_landing(spark, star.read_table(spark, sf_dir, "events"), "stream-src", 1000)
    out, ckpt = scratch_path(spark, "stream-hours"), scratch_path(spark, "stream-hours-ckpt")
    stream = J.file_stream(spark, src, EVENT_SCHEMA, max_files_per_trigger=J.files_per_batch(spark, src, 4))
    J.run(J.hour_partitioned_sink(stream, "ts", out, ckpt, 100))
    return _events_out(SRC.read_landing(spark, out, EVENT_SCHEMA))


@register("stream_exactly_once", """
SELECT 'first' AS run, COUNT(*) AS rows FROM events
UNION ALL SELECT 'second', COUNT(*) FROM events ORDER BY run""")
def stream_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same file-source query run twice on one checkpoint: the second
    run finds no new files and adds no rows."""
    src = _flat_landing(spark, star.read_table(spark, sf_dir, "events"), "once-src", 1000)
    out, ckpt = scratch_path(spark, "once-out"), scratch_path(spark, "once-ckpt")
    counts = []
    for label in ("first", "second"):
        J.run(J.parquet_sink(J.file_stream(spark, src, EVENT_SCHEMA), out, ckpt))
        counts.append(spark.read.parquet(out).agg(F.count(F.lit(1)).alias("rows"))
                      .select(F.lit(label).alias("run"), "rows"))
    return counts[0].unionByName(counts[1]).orderBy("run")


SESSION_RUNS = 4


def run_sessions(spark: SparkSession, sf_dir: str) -> tuple[str, list[dict[str, int]]]:
    """Land the events in ``SESSION_RUNS`` spans of their time, and run the
    session stream to its end after each, as a scheduled job would.  A last
    landing holds only the closing record, after which no session is open.
    Returns the sink and the progress of each run; a row dropped as late is
    an error, since its event would be lost."""
    events = star.read_table(spark, sf_dir, "events").where("ts is not null")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    src, out, ckpt = scratch_path(spark, "sess-src"), scratch_path(spark, "sess-out"), scratch_path(spark, "sess-ckpt")
    if first is None:
        spark.createDataFrame([], "user_id long, events long, first_ts timestamp, last_ts timestamp").write.parquet(out)
        return out, []
    span = (last - first) / SESSION_RUNS
    bounds = [first + span * k for k in range(SESSION_RUNS)] + [last + timedelta(microseconds=1)]
    closing = last + timedelta(days=2)
    landings = [events.where((F.col("ts") >= F.lit(a)) & (F.col("ts") < F.lit(b))) for a, b in zip(bounds, bounds[1:])]
    landings.append(spark.range(1).select(*(F.lit(closing if f.name == "ts" else None).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA)))
    steps = []
    for landing in landings:
        landing.write.mode("append").options(**TIMESTAMP_OPTIONS).json(src)
        stream = J.file_stream(spark, src, EVENT_SCHEMA).withColumn("t", TM.ntz_to_instant("ts"))
        closed = J.closed_sessions(stream, "user_id", "t", f"{SESSION_GAP_SECONDS} seconds", "1 hour", closing.replace(tzinfo=timezone.utc))
        steps.append(J.progress_of(J.run(J.parquet_sink(closed, out, ckpt))))
        if steps[-1]["late_rows"]:
            raise RuntimeError(f"{steps[-1]['late_rows']} late events")
    return out, steps


@register("stream_sessions", f"""
WITH e AS (
  SELECT user_id, ts,
         CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                OR epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts))
                   >= {SESSION_GAP_SECONDS} * 1000000
              THEN 1 ELSE 0 END AS new_session
  FROM events WHERE ts IS NOT NULL),
s AS (SELECT user_id, ts, SUM(new_session) OVER (PARTITION BY user_id ORDER BY ts
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM e)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_end, COUNT(*) AS events
FROM s GROUP BY user_id, sid""")
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap sessions (30 minutes) by a streaming session-window aggregation in
    append mode."""
    res = spark.read.schema("user_id long, events long, first_ts timestamp, last_ts timestamp").parquet(run_sessions(spark, sf_dir)[0])
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return res.select("user_id", F.date_format(TM.instant_to_ntz("first_ts"), fmt).alias("session_start"),
                      F.date_format(TM.instant_to_ntz("last_ts"), fmt).alias("session_end"), "events")


# Two bulk polls of the fact table, one minute apart (poll times are the
# stream's event time for the dedup watermark).
POLL_TIMES = ["2026-08-16 07:00:00", "2026-08-16 07:01:00"]


@register("stream_dedup_repolls", with_star("order_lines") + """
SELECT DISTINCT order_item_id, dt_update FROM order_lines""")
def stream_dedup_repolls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bulk-mode feed re-publishes the whole table every poll; the stream
    keeps the first copy of each (key, version) within a 10-minute
    watermark on poll time."""
    lines = star.order_lines(spark, sf_dir).select("order_item_id", "dt_update", "quantity")
    src = scratch_path(spark, "repoll-src")
    for t in POLL_TIMES:
        (lines.withColumn("polled_at", F.lit(t).cast("timestamp_ntz")).write.mode("append")
         .options(**TIMESTAMP_OPTIONS, **GZIP).option("maxRecordsPerFile", 20000).json(src))
    schema = T.StructType(lines.schema.fields + [T.StructField("polled_at", T.TimestampNTZType())])
    stream = J.file_stream(spark, src, schema, max_files_per_trigger=J.files_per_batch(spark, src, 2)).withColumn(
        "t", TM.ntz_to_instant("polled_at"))
    deduped = J.dedup_within_watermark(stream, ["order_item_id", "dt_update"], "t", "10 minutes")
    out, ckpt = scratch_path(spark, "repoll-out"), scratch_path(spark, "repoll-ckpt")
    J.run(J.parquet_sink(deduped.drop("t"), out, ckpt), spark=spark)
    return spark.read.parquet(out).select("order_item_id", "dt_update")


@register("stream_upsert_latest", with_star("order_items") + _LATEST_SQL)
def stream_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact change feed streamed in several micro-batches; each batch is
    merged into a versioned target keeping the newest row per key.  The
    final version equals the latest state of every key."""
    items = star.order_items(spark, sf_dir)
    src = _flat_landing(spark, items, "upsert-src", 8000)
    root, ckpt = scratch_path(spark, "upsert-target"), scratch_path(spark, "upsert-ckpt")
    stream = J.file_stream(spark, src, items.schema, max_files_per_trigger=J.files_per_batch(spark, src, 2))
    J.run(stream.writeStream.option("checkpointLocation", ckpt)
          .foreachBatch(J.upsert_versions(root, ["order_item_id"], star.fact_sort_keys())))
    return _money_out(versioned.live(versioned.read(spark, root))).select(*LATEST_COLS)


@register("stream_upsert_deletes", with_star("order_lines") + """
SELECT order_item_id, dt_update, CAST(quantity AS DOUBLE) AS quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY order_item_id
      ORDER BY dt_update DESC, quantity DESC, return_flag DESC) AS rn FROM order_lines) t
WHERE rn = 1 AND return_flag <> 'R'""")
def stream_upsert_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change envelopes of the fact, deletes (op 'd') for returned lines,
    streamed in micro-batches, unwrapped in the batch and applied by key: a
    key whose latest change is a delete is gone, an older change that
    arrives later doesn't bring it back."""
    lines = star.order_lines(spark, sf_dir).select("order_item_id", "dt_update", "quantity", "return_flag")
    op = F.when(F.col("return_flag") == "R", "d").otherwise("c")
    src = scratch_path(spark, "delete-src")
    wire.envelope(lines, op, "dt_update").write.options(**GZIP).option("maxRecordsPerFile", 8000).text(src)
    root, ckpt = scratch_path(spark, "delete-target"), scratch_path(spark, "delete-ckpt")
    apply = J.upsert_versions(root, ["order_item_id"], ["dt_update", "quantity", "return_flag"], op_col="__op")

    def unwrapped(batch: DataFrame, batch_id: int) -> None:
        apply(wire.unwrap(batch, "value", lines.schema).drop("__deleted"), batch_id)
    stream = J.file_stream(spark, src, T.StructType([T.StructField("value", T.StringType())]), "text", J.files_per_batch(spark, src, 2))
    J.run(stream.writeStream.option("checkpointLocation", ckpt).foreachBatch(unwrapped))
    return versioned.live(versioned.read(spark, root)).select(
        "order_item_id", "dt_update", F.col("quantity").cast("double").alias("quantity"))


# The events landed first without, later with the column ``value``: before and
# from this event_id on.
EVOLVES_AT = 400


@register("stream_evolving_load", f"""
SELECT event_id, user_id, event_type, CASE WHEN event_id % 1000 < {EVOLVES_AT} THEN NULL ELSE value END AS value,
       'ecommerce.brz_events' AS kafka_topic, strftime(ts, '%Y-%m-%d %H') AS blob_partition_hour, 0 AS rescued
FROM events""")
def stream_evolving_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed per hour in two goes, the second with one column more;
    the load runs after each, on one checkpoint.  All rows of both goes come
    back under the wider schema, with topic and hour of their files."""
    events = star.read_table(spark, sf_dir, "events")
    landing, root, ckpt = scratch_path(spark, "evolving"), scratch_path(spark, "evolving-target"), scratch_path(spark, "evolving-ckpt")
    early = F.col("event_id") % 1000 < EVOLVES_AT
    for rows in (events.where(early).select("event_id", "ts", "user_id", "event_type"),
                 events.where(~early).select("event_id", "ts", "user_id", "event_type", "value")):
        write_hour_partitioned(rows, f"{landing}/ecommerce.brz_events", "ts", 1000)
        J.run(evolving.evolving_load(spark, landing, root, ckpt, T.StructType([f for f in EVENT_SCHEMA if f.name == "ts"])))
    back = versioned.read(spark, root)
    return back.select("event_id", "user_id", "event_type", F.col("value").cast("double").alias("value"),
                       F.col("_kafka_topic").alias("kafka_topic"), F.col("_blob_partition_hour").alias("blob_partition_hour"),
                       F.when(F.col(evolving.RESCUED).isNull(), 0).otherwise(1).alias("rescued"))


@register("stream_fan_out", with_star("order_lines", "products", "customers") + """
, m AS (SELECT 'order_lines' AS sink_folder, order_item_id AS key, return_flag = 'R' AS tomb FROM order_lines
  UNION ALL SELECT 'products', CAST(product_id AS VARCHAR), false FROM products
  UNION ALL SELECT 'customers', CAST(customer_id AS VARCHAR), false FROM customers)
SELECT sink_folder, key, COUNT(*) AS messages FROM m WHERE NOT tomb GROUP BY sink_folder, key""")
def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three topics in one landing of messages (a returned line is a null
    value), filed by one streaming query into a folder per topic."""
    feeds = [(star.order_lines(spark, sf_dir), "order_lines", "order_item_id", F.col("return_flag") == "R"),
             (star.products(spark, sf_dir), "products", "product_id", F.lit(False)),
             (star.customers(spark, sf_dir), "customers", "customer_id", F.lit(False))]
    src, out, ckpt = scratch_path(spark, "fan-src"), scratch_path(spark, "fan-out"), scratch_path(spark, "fan-ckpt")
    for df, table, key, gone in feeds:
        incremental.route_topic(df, TOPIC_PREFIX, table).select(
            F.col("_topic").alias("topic"), F.col(key).cast("string").alias("key"),
            F.when(~gone, wire.encode_row(df.columns)).alias("value")).write.mode("append").option("maxRecordsPerFile", 20_000).parquet(src)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("topic", "key", "value")])
    messages = J.file_stream(spark, src, schema, "parquet", J.files_per_batch(spark, src, 8))
    J.run(J.fan_out(messages, strip_prefix(F.col("topic"), re.escape(TOPIC_PREFIX)), out, ckpt))
    back = spark.read.schema("key string, sink_folder string").json(out)
    return back.groupBy("sink_folder", "key").agg(F.count(F.lit(1)).alias("messages"))
