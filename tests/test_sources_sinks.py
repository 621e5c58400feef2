"""File sources and sinks: hazards H1-H5, corrupt-record split, idempotent
partition reload, schema evolution, snapshots, retention."""

from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sinks import bronze as B
from tessera.sinks import files as K
from tessera.sources import files as S
from tests.conftest import write_text

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def _ndjson(rows):
    return "\n".join(json.dumps({"id": i, "name": n}) for i, n in rows) + "\n"


def test_h1_multiline_on_ndjson_loses_rows_and_probe_does_not(spark, scratch):
    write_text(f"{scratch}/in/a.json", _ndjson([(1, "a"), (2, "b"), (3, "c")]))
    write_text(f"{scratch}/in/b.json", json.dumps([{"id": 4, "name": "d"}, {"id": 5, "name": "e"}], indent=2))
    # the hazard: multiLine reads only the first record of an NDJSON file
    assert S.read_json_array(spark, f"{scratch}/in/a.json", SCHEMA).count() == 1
    layouts = {os.path.basename(r.file): r.layout for r in S.probe_json(spark, f"{scratch}/in").collect()}
    assert layouts == {"a.json": "ndjson", "b.json": "document"}
    got = sorted(r.id for r in S.read_json_auto(spark, f"{scratch}/in", SCHEMA)[0].collect())
    assert got == [1, 2, 3, 4, 5]


def test_h2_malformed_line_is_split_not_fatal(spark, scratch):
    write_text(f"{scratch}/in/a.json", '{"id": 1, "name": "a"}\n{"id": 2, "name": \n{"id": 3, "name": "c"}\n')
    df = S.read_ndjson(spark, f"{scratch}/in", SCHEMA)
    good, bad = S.split_corrupt(df)
    assert sorted(r.id for r in good.collect()) == [1, 3]
    bad_rows = bad.collect()
    assert len(bad_rows) == 1 and bad_rows[0][S.CORRUPT].startswith('{"id": 2')
    assert bad_rows[0]._source_file.endswith("a.json")


def test_h3_base_path_keeps_partition_columns(spark, scratch):
    base = f"{scratch}/landing"
    write_text(f"{base}/year=2026/month=08/day=16/hour=07/p0.json", _ndjson([(1, "a")]))
    write_text(f"{base}/year=2026/month=08/day=16/hour=08/p0.json", _ndjson([(2, "b")]))
    write_text(f"{base}/year=2026/month=08/day=17/hour=00/p0.json", _ndjson([(3, "c")]))
    sub = S.read_landing(spark, base, SCHEMA, sub="year=2026/month=08/day=16")
    rows = sorted((r.id, r.year, r.month, r.day, r.hour) for r in sub.collect())
    assert rows == [(1, "2026", "08", "16", "07"), (2, "2026", "08", "16", "08")]
    whole = S.read_landing(spark, base, SCHEMA)
    sliced = S.day_slice(whole, "2026", "08", "17")
    assert [r.id for r in sliced.collect()] == [3]
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day" in plan


def test_k3_same_day_loaded_twice_is_idempotent(spark, scratch):
    path = f"{scratch}/bronze"
    day1 = B.with_bronze_metadata(spark.range(10).withColumnRenamed("id", "k"), "2026-08-16")
    day2 = B.with_bronze_metadata(spark.range(5).withColumnRenamed("id", "k"), "2026-08-17")
    B.reload_partition(day1, path)
    B.reload_partition(day2, path)
    B.reload_partition(day1, path)  # rerun of day 1
    back = spark.read.parquet(path)
    counts = {str(r[B.PROCESSING_DATE]): r["count"] for r in back.groupBy(B.PROCESSING_DATE).count().collect()}
    assert counts == {"2026-08-16": 10, "2026-08-17": 5}
    # H5: the partition column comes back as a DATE
    assert isinstance(back.schema[B.PROCESSING_DATE].dataType, T.DateType)


def test_k1_append_with_new_column(spark, scratch):
    path = f"{scratch}/evolving"
    B.append_evolving(B.with_bronze_metadata(spark.range(3).withColumnRenamed("id", "k"), "2026-08-16"), path)
    wider = spark.range(2).withColumnRenamed("id", "k").withColumn("extra", F.lit("x"))
    B.append_evolving(B.with_bronze_metadata(wider, "2026-08-17"), path)
    back = B.read_evolving(spark, path)
    assert "extra" in back.columns and back.count() == 5
    assert back.where("extra IS NULL").count() == 3


def test_k13_run_tables_isolates_failures(spark):
    def load(name):
        if name == "bad":
            raise ValueError("boom")
        return 7
    rows = {r.table: (r.status, r.rows) for r in B.run_tables(spark, ["a", "bad", "c"], load).collect()}
    assert rows == {"a": ("SUCCESS", 7), "bad": ("FAILED", None), "c": ("SUCCESS", 7)}


def test_hour_partitioned_sink_and_retention(spark, scratch):
    base = f"{scratch}/hours"
    ts = [dt.datetime(2026, 8, 16, 7, 5), dt.datetime(2026, 8, 16, 7, 59), dt.datetime(2026, 8, 14, 23, 0)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ts)], "id bigint, ts timestamp")
    K.write_hour_partitioned(df, base, "ts", max_records_per_file=1)
    files = [f for d, _, fs in os.walk(base) for f in fs if f.endswith(".json")]
    assert len(files) == 3  # one row per file
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampType())])
    back = S.read_landing(spark, base, schema)
    assert sorted((r.id, r.hour) for r in back.collect()) == [(0, "07"), (1, "07"), (2, "23")]
    removed = K.drop_partitions_before(spark, base, "2026-08-15")
    assert removed == ["2026-08-14"]
    assert sorted(r.id for r in S.read_landing(spark, base, schema).collect()) == [0, 1]


def test_snapshot_path_and_overwrite(spark, scratch):
    p = K.write_snapshot(spark.range(3), scratch, "brz_orders", "20260816_071141")
    assert p.endswith("/orders/snapshot_ts=20260816_071141")
    K.write_snapshot(spark.range(2), scratch, "brz_orders", "20260816_071141")
    assert spark.read.json(p).count() == 2


def test_json_array_parts_are_readable_multiline(spark, scratch):
    df = spark.range(0, 7, numPartitions=3).withColumn("name", F.concat(F.lit("n"), F.col("id")))
    K.write_json_array_parts(df, f"{scratch}/arr")
    back, bad = S.read_json_auto(spark, f"{scratch}/arr", SCHEMA)
    assert bad.count() == 0
    assert sorted(r.id for r in back.collect()) == list(range(7))


def test_csv_decimal_comma(spark, scratch):
    write_text(f"{scratch}/b.csv", "Data;Taxa;PU\n06/01/2024;12,73;1.631,40\n07/01/2024;bad;1,5\n")
    df = S.read_decimal_comma_csv(spark, f"{scratch}/b.csv", ["Data", "Taxa", "PU"],
                                  {"Taxa": "decimal(10,2)", "PU": "decimal(10,2)"}, ["Data"])
    rows = df.orderBy("Data").collect()
    assert str(rows[0].Taxa) == "12.73" and str(rows[0].PU) == "1631.40"
    assert rows[0].Data == dt.date(2024, 1, 6)
    assert rows[1].Taxa is None
