"""Structured Streaming: exactly-once file ingest (T4), re-poll dedup (T8),
session windows vs the batch answer (T5), tombstones (T7), versioned
foreachBatch upserts (T6)."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.sessions import sessions_by_gap
from tessera.streaming import jobs as J
from tests.conftest import write_text

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampType()),
                       T.StructField("user", T.StringType())])


def _lines(rows):
    return "\n".join(json.dumps({"id": i, "ts": t, "user": u}) for i, t, u in rows) + "\n"


def test_t4_rerun_adds_nothing_new_file_adds_its_rows(spark, scratch):
    src, out, ckpt = f"{scratch}/src", f"{scratch}/out", f"{scratch}/ckpt"
    write_text(f"{src}/a.json", _lines([(1, "2026-08-16T07:00:00", "u"), (2, "2026-08-16T07:01:00", "u")]))
    for _ in range(2):
        J.run(J.parquet_sink(J.file_stream(spark, src, SCHEMA), out, ckpt), timeout_s=120)
    assert spark.read.parquet(out).count() == 2
    write_text(f"{src}/b.json", _lines([(3, "2026-08-16T08:00:00", "v")]))
    J.run(J.parquet_sink(J.file_stream(spark, src, SCHEMA), out, ckpt), timeout_s=120)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_t8_dedup_within_watermark(spark, scratch):
    src, out, ckpt = f"{scratch}/src", f"{scratch}/out", f"{scratch}/ckpt"
    rows = [(1, "2026-08-16T07:00:00", "u"), (2, "2026-08-16T07:00:30", "u")]
    write_text(f"{src}/poll1.json", _lines(rows))
    write_text(f"{src}/poll2.json", _lines(rows))  # the bulk re-poll
    stream = J.dedup_within_watermark(J.file_stream(spark, src, SCHEMA, max_files_per_trigger=1),
                                      ["id"], "ts", "10 minutes")
    J.run(J.parquet_sink(stream, out, ckpt), timeout_s=120)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2]


def test_t5_stream_sessions_match_batch(spark, scratch):
    src, out, ckpt = f"{scratch}/src", f"{scratch}/out", f"{scratch}/ckpt"
    base = dt.datetime(2026, 8, 16, 7, 0)
    rows = []
    for n, minutes in enumerate([0, 10, 25, 70, 80, 200]):
        rows.append((n, (base + dt.timedelta(minutes=minutes)).isoformat(), "u"))
    rows.append((99, base.isoformat(), "w"))
    write_text(f"{src}/a.json", _lines(rows))
    stream = J.session_counts(J.file_stream(spark, src, SCHEMA), "user", "ts", "30 minutes", "1 hour")
    q = stream.writeStream.outputMode("complete").foreachBatch(J.overwrite_each_batch(out)) \
        .option("checkpointLocation", ckpt)
    J.run(q, timeout_s=120)
    got = sorted((r.user, r.events) for r in spark.read.parquet(out).collect())
    batch_df = spark.read.schema(SCHEMA).json(src)
    want = sorted((r.user_id, r.events) for r in
                  sessions_by_gap(batch_df.withColumnRenamed("user", "user_id"), "user_id", "ts", 1800).collect())
    assert got == want == [("u", 1), ("u", 2), ("u", 3), ("w", 1)]


def test_t7_tombstones_dropped(spark):
    df = spark.createDataFrame([("k", None), ("k", "{}")], "key string, value string")
    assert J.drop_tombstones(df).count() == 1


def test_t6_versioned_upsert(spark, scratch):
    root = f"{scratch}/state"
    write = J.upsert_each_batch(root, ["k"], ["dt"])
    write(spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, dt int, v string"), 0)
    write(spark.createDataFrame([(2, 5, "B"), (3, 5, "c"), (1, 0, "old")], "k int, dt int, v string"), 1)
    latest = J.current_version(spark, root)
    assert latest.endswith("v=1")
    got = {r.k: r.v for r in spark.read.parquet(latest).collect()}
    assert got == {1: "a", 2: "B", 3: "c"}
    # a retried batch 1 rebuilds the same version from version 0
    write(spark.createDataFrame([(2, 5, "B"), (3, 5, "c"), (1, 0, "old")], "k int, dt int, v string"), 1)
    assert {r.k: r.v for r in spark.read.parquet(J.current_version(spark, root)).collect()} == got


def test_t1_processing_time_trigger_picks_up_new_files(spark, scratch):
    import time
    src, out, ckpt = f"{scratch}/src", f"{scratch}/out", f"{scratch}/ckpt"
    write_text(f"{src}/a.json", _lines([(1, "2026-08-16T07:00:00", "u")]))
    q = J.run(J.parquet_sink(J.file_stream(spark, src, SCHEMA), out, ckpt), processing_time="1 second")
    try:
        deadline = time.time() + 60
        while time.time() < deadline and q.lastProgress is None:
            time.sleep(0.5)
        write_text(f"{src}/b.json", _lines([(2, "2026-08-16T07:05:00", "u")]))
        while time.time() < deadline:
            q.processAllAvailable()
            if spark.read.parquet(out).count() == 2:
                break
            time.sleep(0.5)
    finally:
        q.stop()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2]


def test_a_backlog_takes_a_fixed_number_of_batches(spark, scratch):
    src, out, ckpt = f"{scratch}/src", f"{scratch}/out", f"{scratch}/ckpt"
    for n in range(30):
        write_text(f"{src}/{n}.json", _lines([(n, "2026-08-16T07:00:00", "u")]))
    per_batch = J.files_per_batch(spark, src, 2)
    assert per_batch * J.BACKLOG_BATCHES >= 30 and J.files_per_batch(spark, f"{scratch}/none", 2) == 2
    stream = J.dedup_within_watermark(J.file_stream(spark, src, SCHEMA, max_files_per_trigger=per_batch), ["id"], "ts", "10 minutes")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    q = J.run(J.parquet_sink(stream, out, ckpt), timeout_s=120, spark=spark)
    assert 2 <= len({p["batchId"] for p in q.recentProgress if p["numInputRows"]}) <= J.BACKLOG_BATCHES
    assert spark.read.parquet(out).count() == 30
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
