"""Versioned tables, stored quarantine, evolving loads, closing sessions,
retention by age: each on inputs that the registered queries don't hold."""

from __future__ import annotations

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tests.conftest import SF_SMOKE, write_text

from tessera.plans import streams
from tessera.quality import quarantine as Q
from tessera.quality import validation as V
from tessera.quality.contracts import ColumnSpec, Contract
from tessera.quality.metrics import daily_sketches, merged_distinct
from tessera.sinks import bronze as B
from tessera.sinks import files, versioned
from tessera.sources import star
from tessera.streaming import evolving
from tessera.streaming import jobs as J


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# -- versions


def test_a_dead_writer_leaves_the_old_version_whole(spark, scratch):
    root = f"{scratch}/t"
    versioned.reload_slices(spark.createDataFrame([("a", 1), ("b", 2)], "day string, v int"), root, "day")
    versioned.stage(spark.createDataFrame([("a", 9)], "day string, v int"), root, F.col("day"))
    assert rows_of(versioned.read(spark, root)) == [("a", 1), ("b", 2)]
    # a draft that was never renamed is no version either
    write_text(f"{root}/_versions/.draft-x", "{")
    assert versioned.versions(spark, root) == [1]
    versioned.reload_slices(spark.createDataFrame([("a", 9)], "day string, v int"), root, "day")
    assert rows_of(versioned.read(spark, root)) == [("a", 9), ("b", 2)]
    assert rows_of(versioned.read(spark, root, versioned.load(spark, root, 1))) == [("a", 1), ("b", 2)]


def test_second_writer_of_a_version_fails(spark, scratch):
    root = f"{scratch}/t"
    base = versioned.load(spark, root)
    df = spark.createDataFrame([("a", 1)], "day string, v int")
    versioned.append(df, root, "day")
    with pytest.raises(versioned.CommitConflict):
        versioned.commit(spark, root, base)
    assert rows_of(versioned.read(spark, root)) == [("a", 1)]


def test_reload_empties_named_slices_and_awkward_names(spark, scratch):
    root = f"{scratch}/t"
    rows = [("2026-01-01", 1), ("a/b=c %", 2), (None, 3)]
    versioned.reload_slices(spark.createDataFrame(rows, "day string, v int"), root, "day")
    assert rows_of(versioned.read(spark, root)) == sorted(rows, key=repr)
    none = spark.createDataFrame([], "day string, v int")
    versioned.reload_slices(none, root, "day", ["a/b=c %"])
    assert rows_of(versioned.read(spark, root)) == sorted([rows[0], rows[2]], key=repr)
    versioned.reload_slices(none, f"{scratch}/empty", "day")
    assert versioned.read(spark, f"{scratch}/empty").count() == 0


def test_new_columns_are_added_and_changed_types_refused(spark, scratch):
    root = f"{scratch}/t"
    versioned.append(spark.createDataFrame([("a", 1)], "day string, v int"), root, "day")
    versioned.append(spark.createDataFrame([("b", 2, "x")], "day string, v int, w string"), root, "day")
    assert rows_of(versioned.read(spark, root)) == [("a", 1, None), ("b", 2, "x")]
    with pytest.raises(TypeError):
        versioned.append(spark.createDataFrame([("c", "no")], "day string, v string"), root, "day")


def test_upsert_deletes_late_changes_repeats_and_growth(spark, scratch):
    root, schema = f"{scratch}/t", "k string, v int, ts long, op string"
    batches = [[("a", 1, 1, "c"), ("b", 1, 1, "c")], [("a", 1, 5, "d"), ("c", 3, 2, "c")], [("a", 9, 3, "u"), ("b", 2, 6, "u")],
               [("b", 3, 7, "u")], [("b", 4, 8, "u")]]
    for n, rows in enumerate([*batches, batches[-1]]):
        n = min(n, len(batches) - 1)  # the last batch comes twice
        versioned.upsert(spark.createDataFrame(rows, schema), root, ["k"], ["ts", "v"], "op", mark=("feed", n), bucket_bytes=500)
    assert rows_of(versioned.live(versioned.read(spark, root))) == [("b", 4, 8), ("c", 3, 2)]
    version = versioned.load(spark, root)
    assert version.number == len(batches) and version.buckets > 1
    seen = [b for n in range(1, version.number + 1) for b in [versioned.load(spark, root, n).buckets]]
    assert seen == sorted(seen)


def test_upsert_rewrites_touched_buckets_only(spark, scratch):
    root = f"{scratch}/t"
    all_rows = spark.range(4_000).select(F.col("id").alias("k"), F.lit(1).alias("ts"))
    for _ in range(2):  # the second time the table's size is known
        first = versioned.upsert(all_rows, root, ["k"], ["ts"], bucket_bytes=4_000)
    second = versioned.upsert(all_rows.where("k = 7").withColumn("ts", F.lit(2)), root, ["k"], ["ts"], bucket_bytes=1 << 30)
    assert first.buckets >= 4 and sum(first.slices[n] != second.slices[n] for n in first.slices) == 1
    assert versioned.read(spark, root).agg(F.count("*"), F.sum("ts")).first()[:] == (4_000, 4_001)


def test_markers_of_deleted_keys_go(spark, scratch):
    root, schema = f"{scratch}/t", "k string, ts long, op string"
    versioned.upsert(spark.createDataFrame([("a", 5, "d")], schema), root, ["k"], ["ts"], "op", marker_versions=1)
    for n in (1, 2):
        versioned.upsert(spark.createDataFrame([("b", n, "c")], schema), root, ["k"], ["ts"], "op", marker_versions=1)
    assert [r.k for r in versioned.read(spark, root).collect()] == ["b"]


def test_expire_keeps_what_versions_name(spark, scratch):
    root = f"{scratch}/t"
    for v in range(4):
        versioned.reload_slices(spark.createDataFrame([("a", v)], "day string, v int"), root, "day")
    versioned.stage(spark.createDataFrame([("a", 9)], "day string, v int"), root, F.col("day"))
    assert versioned.expire(spark, root, keep=2) == 0  # all folders are young
    assert versioned.versions(spark, root) == [3, 4]
    assert versioned.expire(spark, root, keep=2, idle_seconds=-1.0) == 3
    assert rows_of(versioned.read(spark, root)) == [("a", 3)]


def test_rows_and_mark_are_one_commit(spark, scratch):
    root = f"{scratch}/t"
    df = spark.createDataFrame([(1, 1)], "poll int, v int")
    versioned.append(df, root, "poll", {"cursor": ["x", 1]})
    versioned.stage(df, root, F.col("poll").cast("string"))
    assert versioned.load(spark, root).marks == {"cursor": ["x", 1]} and versioned.read(spark, root).count() == 1


# -- the calendar has no bounds of its own


def test_a_line_beyond_any_fixed_range_is_in_every_result(spark, scratch):
    from tessera.plans import load_all
    src = f"{scratch}/sf"
    os.makedirs(src)
    for name in os.listdir(SF_SMOKE):
        if name != "lineitem.parquet":
            os.symlink(f"{SF_SMOKE}/{name}", f"{src}/{name}")
    lines = spark.read.parquet(f"{SF_SMOKE}/lineitem.parquet")
    kind = lines.schema["l_shipdate"].dataType
    first = lines.orderBy("l_orderkey", "l_linenumber").first()
    odd = (F.col("l_orderkey") == first.l_orderkey) & (F.col("l_linenumber") == first.l_linenumber)
    lines.withColumn("l_shipdate", F.when(odd, F.lit("2201-03-04 00:00:00").cast(kind)).otherwise(F.col("l_shipdate"))) \
        .write.parquet(f"{src}/lineitem.parquet")
    n, changed = lines.count(), lines.where(odd).count()
    assert changed >= 1
    run = lambda name: load_all()[name][0](spark, src)
    full = run("star_denormalized")
    assert full.count() == n and full.where("year = 2201 and quarter = 1 and month = 3").count() == changed
    assert run("revenue_by_category_quarter").agg(F.sum("items")).first()[0] == n
    assert run("resolved_order_items").count() == n
    assert run("orphan_counts").where("fk_column = 'date_code'").first().orphans == 0
    assert run("quarantine_rule_counts").where("rule = 'fk:date_code'").count() == 0


def test_days_of_codes(spark):
    codes = spark.createDataFrame([(20240229,), (10000101 // 10 * 10 + 1,), (22010304,), (None,)], "c int")
    assert [r[0] for r in codes.select(star.day_of("c")).collect()] == [dt.date(2024, 2, 29), dt.date(1000, 1, 1), dt.date(2201, 3, 4), None]


# -- streams


def test_sessions_close_and_their_state_goes(spark):
    out, steps = streams.run_sessions(spark, SF_SMOKE)
    assert len(steps) == streams.SESSION_RUNS + 1
    assert any(s["state_rows"] > 0 for s in steps[:-1])
    assert steps[-1]["state_rows"] == 0 and all(s["late_rows"] == 0 for s in steps)
    events = spark.read.parquet(f"{SF_SMOKE}/events.parquet").where("ts is not null").count()
    assert spark.read.parquet(out).agg(F.sum("events")).first()[0] == events


def _land(base, topic, hour, name, rows):
    write_text(f"{base}/{topic}/year=2026/month=08/day=16/hour={hour}/{name}.json", "".join(r if isinstance(r, str) else json.dumps(r) + "\n" for r in rows))


def test_evolving_load_widens_rescues_and_repeats_nothing(spark, scratch):
    landing, root, ckpt = f"{scratch}/landing", f"{scratch}/t", f"{scratch}/ckpt"
    go = lambda: J.run(evolving.evolving_load(spark, landing, root, ckpt))
    _land(landing, "shop.brz_a", "07", "one", [{"id": 1, "x": "a"}, {"id": 2, "x": None, "empty": None}, "not json\n"])
    go()
    go()  # nothing new
    assert evolving.stored_fields(spark, root).names == ["id", "x"]
    _land(landing, "shop.brz_b", "08", "two", [{"id": 3, "x": "b", "price": 1.5, "tags": ["u"]}, {"id": "text", "x": "c", "price": 123456.75}])
    go()
    back = {(r._kafka_topic, r._blob_partition_hour, r.id, r.x, r.price and float(r.price), tuple(r.tags or ()), r._rescued)
            for r in versioned.read(spark, root).collect()}
    assert back == {("shop.brz_a", "2026-08-16 07", 1, "a", None, (), None), ("shop.brz_a", "2026-08-16 07", 2, None, None, (), None),
                    ("shop.brz_a", "2026-08-16 07", None, None, None, (), "not json"),
                    ("shop.brz_b", "2026-08-16 08", 3, "b", 1.5, ("u",), None),
                    ("shop.brz_b", "2026-08-16 08", None, "c", 123456.75, (), '{"id": "text", "x": "c", "price": 123456.75}')}
    assert all(r._source_file and r._ingested_at for r in versioned.read(spark, root).collect())


def test_evolving_batch_that_is_repeated_does_nothing(spark, scratch):
    landing, root = f"{scratch}/landing", f"{scratch}/t"
    _land(landing, "t", "07", "one", [{"id": 1}])
    for ckpt in ("a", "b"):  # a lost checkpoint delivers batch 0 again
        J.run(evolving.evolving_load(spark, landing, root, f"{scratch}/{ckpt}"))
    assert versioned.read(spark, root).count() == 1


def test_fan_out_drops_tombstones_and_replaces_a_repeated_batch(spark, scratch):
    src, out = f"{scratch}/src", f"{scratch}/out"
    schema = "topic string, value string"
    spark.createDataFrame([("p.a", "{}"), ("p.a", None), ("p.b", "{}")] + [("p.a", "{}")] * 5, schema).coalesce(1).write.json(src)
    stream = lambda: J.file_stream(spark, src, T._parse_datatype_string(schema))
    for ckpt in ("a", "b"):  # the second run is batch 0 again
        J.run(J.fan_out(stream(), F.substring("topic", 3, 9), out, f"{scratch}/{ckpt}", 2))
    back = spark.read.schema("value string, sink_folder string").json(out)
    assert rows_of(back.groupBy("sink_folder").count()) == [("a", 6), ("b", 1)]
    assert len([f for f in os.listdir(f"{out}/sink_folder=a/_batch=0") if f.startswith("part-")]) == 3


# -- quarantine


ROWS = Contract("rows", 1, (ColumnSpec("k", "string", False), ColumnSpec("v", "int"), ColumnSpec("p", "int")), ("k",),
                rules={"v_positive": "v > 0"}, foreign_keys={"p": ("parents", "p")})


def test_quarantine_replays_rules_parents_and_repeats(spark, scratch):
    root = f"{scratch}/q"
    parents = lambda *ids: {"parents": spark.createDataFrame([(i,) for i in ids], "p int")}
    df = spark.createDataFrame([("a", 1, 1), ("b", -1, 1), ("c", 1, 2), ("d", 1, 2), ("d", 1, 2), (None, 1, 1)], "k string, v int, p int")
    first = Q.store(df, root, ROWS, parents(1), "r1", "v1")
    assert Q.store(df, root, ROWS, parents(1), "r1", "v1").number == first.number  # the run is there already
    assert Q.counts(spark, root, first).first()[:] == (1, 5)
    second = Q.replay(spark, root, ROWS, parents(1, 2), "v2")
    assert Q.counts(spark, root, second).first()[:] == (2, 4)
    loose = Contract("rows", 2, ROWS.columns, ROWS.key, foreign_keys=ROWS.foreign_keys)
    third = Q.replay(spark, root, loose, parents(1, 2), "v3")
    assert Q.counts(spark, root, third).first()[:] == (3, 3)
    held = versioned.read(spark, root, third, [Q.QUARANTINED])
    assert rows_of(held.select("k", F.array_join(V.FAILED, ","), Q.RUN, Q.RULES)) == [
        ("d", "duplicate_key", "r1", "v3"), ("d", "duplicate_key", "r1", "v3"), (None, "not_null:k", "r1", "v3")]
    # a key that passed meanwhile keeps a second row with it in quarantine
    Q.store(spark.createDataFrame([("a", -5, 1)], df.schema), root, ROWS, parents(1), "r2", "v1")
    last = Q.replay(spark, root, loose, parents(1, 2), "v3")
    assert Q.counts(spark, root, last).first()[:] == (3, 4)


# -- landed schemas, sketches, retention, concurrent runs


def test_landed_violations_follow_the_lines(spark):
    contract = Contract("t", 1, (ColumnSpec("a", "int", False), ColumnSpec("b", "decimal(5,2)"), ColumnSpec("c", "string"), ColumnSpec("d", "date")), ("a",))
    found = lambda *lines: rows_of(V.landed_violations(spark.createDataFrame([(x,) for x in lines], "value string"), contract)
                                   .select("column_name", "violation", "rows"))
    good = '{"a": 1, "b": 2, "c": "x", "d": "2024-01-01"}'
    assert found(good, '{"a": 2, "b": 2.5, "c": null, "d": null}') == []
    assert found(good, '{"b": "x", "e": true}', "no json") == [("a", "incomplete", 1), ("b", "type_mismatch", 2), ("e", "extra", 1)]
    assert found('{"a": null}') == [("a", "missing", 0), ("b", "missing", 0), ("c", "missing", 0), ("d", "missing", 0)]
    assert [r[1] for r in found("[]")] == ["missing"] * 4


def test_sketches_merge_within_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("d"), (F.col("id") % 20_000).alias("u"))
    merged = merged_distinct(daily_sketches(df, F.col("d"), "u")).first()
    assert merged.rows == 60_000 and abs(merged.distinct_values - 20_000) <= 4 * 0.013 * 20_000


def test_retention_by_path_and_by_time(spark, scratch):
    base = f"{scratch}/land"
    for path in ("e/year=2026/month=08/day=01/hour=00/a.json", "e/year=2026/month=05/day=01/hour=00/a.json",
                 "s/t/snapshot_ts=20260810T000000/a.json", "s/t/snapshot_ts=2026-08-01/a.json", "loose/new.json", "loose/old.json"):
        write_text(f"{base}/{path}", "{}")
    for path, day in (("loose/new.json", "2026-08-10"), ("loose/old.json", "2026-01-01")):
        stamp = time.mktime(dt.date.fromisoformat(day).timetuple())
        os.utime(f"{base}/{path}", (stamp, stamp))
    assert files.retain(spark, base, "2026-08-15") == 3
    left = sorted(r.path.split("/land/")[1] for r in files.landed_files(spark, base).collect())
    assert left == ["e/year=2026/month=08/day=01/hour=00/a.json", "loose/new.json", "s/t/snapshot_ts=20260810T000000/a.json"]
    assert files.retain(spark, base, "2026-08-15") == 0


def test_tables_load_at_once_in_pools_of_their_own(spark):
    seen = {}

    def load(table):
        seen[table] = (spark.sparkContext.getLocalProperty("spark.scheduler.pool"), spark.sparkContext.getLocalProperty("spark.jobGroup.id"))
        if table == "bad":
            raise ValueError("no such table")
        return spark.range(3).count()
    rows = {r.table: (r.status, r.rows, r.error) for r in B.run_tables(spark, ["a", "bad", "c"], load, at_once=2).collect()}
    assert rows == {"a": ("SUCCESS", 3, None), "bad": ("FAILED", None, "ValueError: no such table"), "c": ("SUCCESS", 3, None)}
    assert seen == {t: (t, f"bronze {t}") for t in ("a", "bad", "c")}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


# -- values that parsing would lose


def test_wire_decimals_beyond_eight_bytes(spark):
    import base64
    from decimal import Decimal

    from tessera.functions import wire

    def encoded(n):
        size = max(1, (n + (n < 0)).bit_length() // 8 + 1)
        return base64.b64encode(n.to_bytes(size, "big", signed=True)).decode()
    big = [0, 5, -5, 255, -256, 2 ** 63 - 1, -2 ** 63, 2 ** 63, 2 ** 64, -2 ** 64 - 1, 10 ** 38 - 1, -(10 ** 38 - 1)]
    for scale in (0, 4):
        got = spark.createDataFrame([(encoded(n),) for n in big], "v string").select(wire.wire_to_decimal("v", 38, scale, 16)).collect()
        assert [r[0] for r in got] == [Decimal(f"{n}e-{scale}") for n in big]
    lost = [encoded(10 ** 38), encoded(2 ** 126 + 2 ** 125 + 2 ** 124), encoded(2 ** 200), encoded(10 ** 11), "!!", ""]
    df = spark.createDataFrame([(v,) for v in lost], "v string")
    out = V.keep_lost(df, {"price": ("v", wire.wire_to_decimal("v", 10, 0, 16))})
    assert [r.price for r in out.collect()] == [None] * len(lost)
    assert [[x.raw for x in r[V.UNCASTABLE]] for r in out.collect()] == [[v] if v else [] for v in lost]


# -- contract registry


def test_registry_classifies_as_the_policy(spark, scratch):
    import random

    from tessera.quality import registry as R
    from tessera.quality.contracts import classify_change
    rng, root = random.Random(4), f"{scratch}/r"
    types = ["int", "bigint", "tinyint", "float", "double", "string", "decimal(10,2)", "decimal(12,2)", "decimal(12,4)", "decimal(20,0)"]
    contracts = []
    for _ in range(8):
        columns = [ColumnSpec("k", "string", False)] + [ColumnSpec(c, rng.choice(types), rng.random() < 0.5) for c in "abcdef" if rng.random() < 0.8]
        contracts.append(Contract("t", len(contracts) + 1, tuple(columns), ("k",)))
        assert R.register(spark, root, "t", R.columns_of(spark, contracts[-1])) == len(contracts)
    assert R.register(spark, root, "other", R.columns_of(spark, contracts[0])) == 1
    got = sorted(map(tuple, R.changes(versioned.read(spark, root)).collect()))
    expect = sorted(("t", n, n + 1, *c) for n, (a, b) in enumerate(zip(contracts, contracts[1:]), start=1) for c in classify_change(a, b))
    assert got == expect and len({c[-1] for c in expect}) == 2
