"""Scalar functions: wire decimals, epoch millis, calendar attributes,
standardization (FIXTURES.md §3)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tessera.functions import standardize as S
from tessera.functions import time as TM
from tessera.functions import wire as W


def test_wire_decimal_signs(spark):
    df = spark.createDataFrame([("Opc=",), ("+w==",), ("AA==",), ("AIA=",)], "b string")
    got = [r.d for r in df.select(W.wire_to_decimal("b", 10, 2).alias("d")).collect()]
    assert got == [Decimal("149.99"), Decimal("-0.05"), Decimal("0.00"), Decimal("1.28")]


def test_wire_decimal_roundtrip(spark):
    vals = ["149.99", "-0.05", "0.00", "1.28", "-1.28", "-1.29", "99999999.99", "-99999999.99", "0.01"]
    df = spark.createDataFrame([(v,) for v in vals], "v string").select(F.col("v").cast("decimal(10,2)").alias("v"))
    out = df.select("v", W.decimal_to_wire("v", 2).alias("b")).select(
        "v", "b", W.wire_to_decimal("b", 10, 2).alias("back"))
    rows = out.collect()
    assert all(r.v == r.back for r in rows)
    by_v = {str(r.v): r.b for r in rows}
    assert by_v["149.99"] == "Opc=" and by_v["-0.05"] == "+w=="


def test_epoch_millis_floor(spark):
    df = spark.createDataFrame([(0,), (-1500,), (1734381830665,)], "ms bigint")
    rows = df.select(TM.millis_to_date_text("ms").alias("d"), TM.millis_to_timestamp_text("ms").alias("t")).collect()
    assert [r.d for r in rows] == ["1970-01-01", "1969-12-31", "2024-12-16"]
    assert [r.t for r in rows] == ["1970-01-01 00:00:00", "1969-12-31 23:59:58", "2024-12-16 20:43:50"]


def test_ntz_millis_roundtrip(spark):
    df = spark.createDataFrame([(-1500,), (1734381830665,)], "ms bigint")
    rows = df.select(TM.ntz_millis(TM.millis_to_ntz("ms")).alias("back"), "ms").collect()
    assert all(r.back == r.ms for r in rows)


def test_saturday_calendar_attributes(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 6),), (dt.date(2024, 1, 8),)], "d date")
    rows = df.select(TM.date_code("d").alias("code"), TM.iso_weekday("d").alias("dow"),
                     TM.is_weekend("d").alias("we"), TM.day_name("d").alias("dn"),
                     TM.month_name("d").alias("mn")).collect()
    assert (rows[0].code, rows[0].dow, rows[0].we, rows[0].dn, rows[0].mn) == (20240106, 6, True, "Saturday", "January")
    assert (rows[1].dow, rows[1].we, rows[1].dn) == (1, False, "Monday")


def test_calendar_dimension_row_count(spark):
    from tessera.operators.dimensions import calendar_between
    bounds = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2026, 12, 31))], "start date, end date")
    cal = calendar_between(bounds)
    assert cal.count() == 1096
    assert cal.where("date_code = 20240106").select("is_weekend").first()[0] is True


def test_day_first_and_decimal_comma(spark):
    df = spark.createDataFrame([("06/01/2024", "1.234,56"), ("31/02/2024", "12,5"), ("bad", "x")], "d string, n string")
    rows = df.select(TM.parse_day_first("d").alias("d"), S.decimal_comma("n").alias("n")).collect()
    assert rows[0].d == dt.date(2024, 1, 6) and rows[0].n == Decimal("1234.56")
    assert rows[1].n == Decimal("12.50")
    assert rows[2].d is None and rows[2].n is None


def test_standardize(spark):
    df = spark.createDataFrame([(" (11) 98765-4321 ", " br ", "brz_orders", "CAT-GROCERY")],
                               "p string, cc string, t string, c string")
    r = df.select(S.normalize_phone("p").alias("p"), S.normalize_country_code("cc").alias("cc"),
                  S.strip_prefix("t").alias("t"), S.remap_code_suffix("c").alias("c")).first()
    assert r.p == "11987654321" and r.cc == "BR" and r.t == "orders" and r.c == "CAT-GRCY"


def test_fill_zero_casts_text(spark):
    df = spark.createDataFrame([(None, None)], "a double, b string")
    r = S.fill_zero(df, ["a"]).first()
    assert r.a == 0.0


def test_envelope_unwrap_tombstone(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    env = W.envelope(df, F.when(F.col("id") == 2, "d").otherwise("c"))
    back = W.unwrap(env, "value", df.schema).orderBy("id").collect()
    assert [(r["id"], r["v"], r["__deleted"]) for r in back] == [(1, "a", False), (2, "b", True)]
