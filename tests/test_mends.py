"""Inputs that once gave wrong answers, lost rows or unpushed filters."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera import session
from tessera.functions import time as TM
from tessera.functions import wire
from tessera.operators import sequence as SEQ
from tessera.operators.dedup import duplicate_stats
from tessera.plans import analytics, load_all
from tessera.quality import validation as V
from tessera.quality.contracts import ColumnSpec, Contract
from tessera.sinks import bronze as B
from tessera.sinks import files as K
from tessera.sources import files as S
from tessera.sources import star
from tessera.streaming import jobs as J
from tests.conftest import SF_SMOKE, write_text


@pytest.fixture(scope="module")
def alike(spark, tmp_path_factory):
    """The smoke tables with two part types that share their first letters."""
    root = str(tmp_path_factory.mktemp("alike"))
    for t in ("region", "nation", "customer", "orders", "lineitem"):
        spark.read.parquet(f"{SF_SMOKE}/{t}.parquet").write.parquet(f"{root}/{t}.parquet")
    part = spark.read.parquet(f"{SF_SMOKE}/part.parquet")
    kind = F.when(F.col("p_partkey") % 2 == 0, "STANDARD BRUSHED").otherwise("STANDARD PLATED")
    part.withColumn("p_type", kind).write.parquet(f"{root}/part.parquet")
    return root


def test_types_that_share_letters_do_not_multiply_the_fact(spark, alike):
    lines = star.order_lines(spark, alike).count()
    assert analytics.star_denormalized(spark, alike).count() == lines
    assert analytics.revenue_by_category_quarter(spark, alike).agg(F.sum("items")).first()[0] == lines
    assert star.category(spark, alike).count() == 2


def test_long_ids_and_fractions_are_kept(spark, alike, scratch):
    big = 12345678901
    spark.createDataFrame([(big, "c", 0, 1.0, "m")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string") \
        .write.parquet(f"{scratch}/customer.parquet")
    for t in ("nation", "region", "lineitem"):
        spark.read.parquet(f"{alike}/{t}.parquet").write.parquet(f"{scratch}/{t}.parquet")
    assert star.customers(spark, scratch).first().phone.endswith(str(big))
    one = spark.read.parquet(f"{alike}/lineitem.parquet").limit(1).withColumn("l_quantity", F.lit(2.75))
    assert star.lines_of(one).first().quantity == Decimal("2.75")


def test_appended_files_are_seen(spark, scratch):
    df = spark.range(10).withColumnRenamed("id", "event_id")
    df.write.parquet(f"{scratch}/events.parquet")
    assert star.read_table(spark, scratch, "events").count() == 10
    df.limit(5).write.mode("append").parquet(f"{scratch}/events.parquet")
    assert star.read_table(spark, scratch, "events").count() == 15


def test_broadcast_follows_the_session(spark):
    df, key = spark.range(5), "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        for value, hinted in (("-1", False), ("10485760", True), ("1", False), ("10m", True)):
            spark.conf.set(key, value)
            plan = session.guarded_broadcast(df)._jdf.queryExecution().logical().toString()
            assert ("broadcast" in plan.lower()) == hinted
    finally:
        spark.conf.set(key, before)


def test_damaged_lines_cost_only_themselves(spark, scratch):
    good = [json.dumps({"id": i, "name": "n"}) for i in range(9)]
    write_text(f"{scratch}/in/a.json", "\n".join(good[:5] + ['{"id": 77, "na'] + good[5:]) + "\n")
    write_text(f"{scratch}/in/b.json", "\n  [ " + json.dumps({"id": 20, "name": "x"}) + ",\n" + json.dumps({"id": 21, "name": "y"}) + "]")
    write_text(f"{scratch}/in/c.json", json.dumps({"id": 30, "name": "z"}, indent=2))
    write_text(f"{scratch}/in/d.json", '[{"id": 40, "name": ')
    rows, bad = S.read_json_auto(spark, f"{scratch}/in", _schema())
    assert sorted(r.id for r in rows.collect()) == [*range(9), 20, 21, 30]
    raw = {r.file.rsplit("/", 1)[1]: r.raw for r in bad.collect()}
    assert set(raw) == {"a.json", "d.json"} and raw["a.json"] == '{"id": 77, "na'
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" not in plan  # no file list came back from the driver


def _schema():
    from pyspark.sql import types as T
    return T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])


def test_landing_has_no_rows_of_nulls(spark, scratch):
    write_text(f"{scratch}/land/year=2024/month=01/day=02/hour=03/a.json", '{"id": 1, "name": "a"}\n{"id": 2, "na\n')
    assert [r.id for r in S.read_landing(spark, f"{scratch}/land", _schema()).collect()] == [1]
    _, bad = S.split_corrupt(S.read_landing(spark, f"{scratch}/land", _schema(), keep_corrupt=True))
    assert [r._corrupt_record for r in bad.collect()] == ['{"id": 2, "na']


def test_carry_forward_keeps_large_longs(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(1, None), (2, big), (3, None), (4, None), (5, 7)], "t long, v long")
    rows = SEQ.carry_forward(df, "v", ["t"], "f", 2).orderBy("t").collect()
    assert [r.f for r in rows] == [None, big, big, big, 7] and [r.v for r in rows] == [None, big, None, None, 7]


@pytest.mark.parametrize("unscaled, scale", [(-(1 << 62), 0), (12345678, 8), (-12345678, 8), (-1, 2), (0, 4), ((1 << 63) - 1, 6),
                                             (-(1 << 63), 9), (128, 0), (-129, 3)])
def test_wire_decimals_are_exact(spark, unscaled, scale):
    import base64
    n = (unscaled + (unscaled < 0)).bit_length() // 8 + 1
    text = base64.b64encode(unscaled.to_bytes(n, "big", signed=True)).decode()
    got = spark.range(1).select(wire.wire_to_decimal(F.lit(text), 38, scale).alias("d")).first().d
    assert got == Decimal(unscaled).scaleb(-scale)
    if scale == 8:
        value = F.lit(Decimal(unscaled).scaleb(-scale)).cast("decimal(18,8)")
        assert spark.range(1).select(wire.decimal_to_wire(value, 8).alias("w")).first().w == text


def test_wire_decimal_of_more_than_eight_bytes_is_null(spark):
    import base64
    text = base64.b64encode(bytes([1] * 9)).decode()
    assert spark.range(1).select(wire.wire_to_decimal(F.lit(text), 38, 2).alias("d")).first().d is None


def test_millis_floor_before_1970(spark):
    df = spark.sql("SELECT timestamp_ntz'1969-12-31 23:59:59.9995' t UNION ALL SELECT timestamp_ntz'1969-12-31 23:59:58.4995'")
    assert sorted(r.m for r in df.select(TM.ntz_millis("t").alias("m")).collect()) == [-1501, -1]


def test_uncastable_values_are_quarantined_with_their_text(spark):
    c = Contract("t", 1, (ColumnSpec("id", "bigint", False), ColumnSpec("amount", "decimal(10,2)")), ("id",))
    df = spark.createDataFrame([(1, "1.50"), (2, "not-a-number"), (3, None)], "id long, amount string")
    passed, bad = V.quarantine_split(V.flag_rules(V.conform(df, c), c))
    assert sorted(r.id for r in passed.collect()) == [1, 3] and V.UNCASTABLE not in passed.columns
    row = bad.first()
    assert row[V.FAILED] == ["cast:amount"] and row[V.UNCASTABLE][0].raw == "not-a-number"


def test_null_keys_do_not_count(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert duplicate_stats(df, ["k"]).first().unique_keys == 1


def test_empty_reload_empties_the_day(spark, scratch):
    df = spark.range(4)
    for day in ("2026-01-01", "2026-01-02"):
        B.reload_partition(B.with_bronze_metadata(df, day), f"{scratch}/b", day=day)
    B.reload_partition(B.with_bronze_metadata(df.limit(0), "2026-01-01"), f"{scratch}/b", day="2026-01-01")
    assert [str(r[0]) for r in spark.read.parquet(f"{scratch}/b").select(B.PROCESSING_DATE).distinct().collect()] == ["2026-01-02"]


def test_failed_table_keeps_its_whole_error(spark):
    def fail(_):
        raise ValueError("first line\n" + "x" * 900)
    assert B.run_tables(spark, ["t"], fail).first().error.endswith("x" * 900)


def test_upsert_applies_deletes_and_ignores_late_changes(spark, scratch):
    schema = "k string, v int, ts long, op string"
    apply = J.upsert_each_batch(f"{scratch}/t", ["k"], ["ts", "v"], op_col="op", buckets=4, keep=2)
    batches = [[("a", 1, 1, "c"), ("b", 1, 1, "c")], [("a", 1, 5, "d"), ("c", 3, 2, "c")], [("a", 9, 3, "u"), ("b", 2, 6, "u")],
               [("b", 3, 7, "u")], [("b", 4, 8, "u")]]
    for n, rows in enumerate(batches):
        apply(spark.createDataFrame(rows, schema), n)
    apply(spark.createDataFrame(batches[-1], schema), len(batches) - 1)  # a retried batch
    data = spark.createDataFrame([], "k string, v int, ts long").schema
    assert sorted(map(tuple, J.read_target(spark, f"{scratch}/t", data).collect())) == [("b", 4, 8), ("c", 3, 2)]
    paths = J.bucket_paths(spark, f"{scratch}/t")
    assert all(len([v for v in J._versions(spark, f"{scratch}/t") if v >= 0]) >= 1 for _ in paths)


def test_one_timestamp_is_spread_over_tasks(spark, scratch):
    df = spark.range(200_000).withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    parts = df.withColumns(TM.hour_parts("ts"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"  # else so little data is merged again
    spark.conf.set(key, "false")
    sizes = K._clustered(parts, K.HOUR_COLS, [F.col("ts"), F.xxhash64("id", "ts")]).groupBy(F.spark_partition_id()).count().collect()
    spark.conf.set(key, "true")
    assert len(sizes) > 4 and max(r["count"] for r in sizes) < 100_000


@pytest.fixture(scope="module")
def events_twice(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("twice"))
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    ev.unionByName(ev).write.parquet(f"{root}/events.parquet")
    return root


@pytest.mark.parametrize("name", ["hour_slice", "millis_range"])
def test_slices_do_not_square_duplicates_and_push_bounds(spark, events_twice, name):
    fn = load_all()[name][0]
    df = fn(spark, events_twice)
    assert df.count() == 2 * fn(spark, "/root/testdata/sf0.01").count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_cursor_bounds_are_pushed(spark):
    for name, low in (("cursor_timestamp", "GreaterThan(l_shipdate"), ("cursor_timestamp_id", "GreaterThanOrEqual(l_shipdate")):
        df = load_all()[name][0](spark, SF_SMOKE)
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        assert low in plan and "LessThanOrEqual(l_shipdate" in plan


@pytest.mark.parametrize("name", ["orphan_counts", "silver_build_counts", "country_customers_orders"])
def test_one_pass_over_the_fact(spark, name):
    plan = load_all()[name][0](spark, SF_SMOKE)._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in plan.splitlines() if "FileScan" in ln and "lineitem" in ln]
    assert len(scans) <= 2 and "Expand" not in plan


def test_reconciliation_finds_the_faults(spark):
    rows = {(r.time_window, r.layer): r for r in load_all()["reconciliation"][0](spark, SF_SMOKE).collect()}
    assert rows["199706", "topic"].lost_keys > 0 and rows["199707", "bronze"].lost_keys > 0
    assert rows["all", "bronze"].lag_ms > 0 and rows["all", "topic"].duplication_rate > 0.4
    assert rows["all", "source"].lost_keys == 0


def test_reconciliation_covers_the_other_tables(spark):
    rows = {(r.table_name, r.layer): r for r in load_all()["reconciliation_dimensions"][0](spark, SF_SMOKE).collect()}
    assert {t for t, _ in rows} == {"category", "brands", "customers", "calendar", "products"} and len(rows) == 20
    assert rows["customers", "topic"].lost_keys > 0 and rows["products", "topic"].lost_keys == 0 < rows["products", "silver"].lost_keys
    assert all(rows[t, "silver"].lost_keys == 0 and rows[t, "bronze"].duplication_rate == 0.5 for t in ("category", "brands", "calendar"))
