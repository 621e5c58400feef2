"""What queries move and write stays in proportion: landed text compressed,
documents of bounded size, no shuffle of the large side by a few keys."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tessera import session
from tessera.operators import sequence as SEQ
from tessera.plans import analytics
from tessera.quality.contracts import ColumnSpec, Contract
from tessera.quality.reconcile import windowed_reconcile
from tessera.quality.validation import FAILED, flag_rules
from tessera.sinks import files as K
from tessera.sinks import versioned as V
from tessera.sources import files as S
from tessera.sources import star
from tests.conftest import SF_SMOKE


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _files(root: str, end: str) -> list[str]:
    return [f"{d}/{n}" for d, _, names in os.walk(root) for n in names if n.endswith(end)]


def test_snapshots_are_compressed_and_read_back(spark, scratch):
    df = spark.range(2000).select("id", F.concat(F.lit("name of "), "id").alias("long_field_name"))
    path = K.write_snapshot(df, scratch, "brz_t", "s")
    assert _files(path, ".json.gz") and not _files(path, ".json")
    text = df.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0]
    assert sum(os.path.getsize(f) for f in _files(path, ".gz")) * 3 < text
    assert spark.read.schema(df.schema).json(path).exceptAll(df).count() == 0


def test_array_documents_have_bounded_rows(spark, scratch):
    df = spark.range(0, 95, 1, 2).select("id", F.lit("x").alias("s"))
    K.write_json_array_parts(df, f"{scratch}/arr", rows=10)
    assert spark.read.option("multiLine", True).schema(df.schema).json(f"{scratch}/arr").groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] == 10
    good, bad = S.read_json_auto(spark, f"{scratch}/arr", df.schema)
    assert sorted(r.id for r in good.collect()) == list(range(95)) and bad.count() == 0
    assert "BroadcastHashJoin" in _plan(good) and "SortMergeJoin" not in _plan(good)
    K.write_json_array_parts(df.where("id < 20").coalesce(1), f"{scratch}/full", rows=10)
    assert spark.read.option("multiLine", True).schema(df.schema).json(f"{scratch}/full").count() == 20
    K.write_json_array_parts(df.limit(0), f"{scratch}/none", rows=10)
    assert spark.read.option("multiLine", True).schema(df.schema).json(f"{scratch}/none").count() == 0


def test_few_groups_are_no_shuffle_key(spark):
    df = spark.range(0, 400, 1, 4).select((F.col("id") % 3).alias("g"), "id")
    out = SEQ.index_within_group(df, ["g"], ["id"], "i", start=0)
    assert "hashpartitioning(g" not in _plan(out)
    assert {(r.g, r.id, r.i) for r in out.collect()} == {(k % 3, k, k // 3) for k in range(400)}


def test_few_slices_are_filed_without_a_shuffle(spark, scratch):
    df = spark.range(0, 400, 1, 4).select("id", (F.col("id") % 2).alias("s"))
    version = V.reload_slices(df, f"{scratch}/t", "s", slices=2)
    assert len(_files(f"{scratch}/t", ".parquet")) == 8 and set(version.slices) == {"0", "1"}
    assert V.read(spark, f"{scratch}/t").count() == 400


def test_the_fact_is_joined_as_numbers_and_once_per_key(spark):
    plan = star.order_items(spark, SF_SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("concat_ws") < plan.index("Join") and "concat_ws" not in plan[plan.index("Join"):]
    plan = analytics.denormalized(spark, SF_SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line.strip(" +-:") for line in plan.splitlines() if "Join Inner" in line]
    fact = joins.index(next(j for j in joins if "l_orderkey" in j))
    assert any("customer_id" in j or "custkey" in j for j in joins[fact + 1:]) and not any("customer_id" in j for j in joins[:fact])


def test_foreign_keys_of_a_large_parent_are_looked_up_by_the_missing_ones(spark):
    contract = Contract("t", 1, (ColumnSpec("id", "bigint"), ColumnSpec("p", "bigint")), ("id",), foreign_keys={"p": ("parents", "k")})
    rows = spark.createDataFrame([(1, 5), (2, 200_001), (3, None), (4, 200_001), (5, 7)], "id long, p long")
    parents = {"parents": spark.range(0, 100_000).select(F.col("id").alias("k"))}
    expect = {1: [], 2: ["fk:p"], 3: [], 4: ["fk:p"], 5: []}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for limit, wide in (("20000", rows), ("-1", rows), ("20000", rows.limit(2))):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            flagged = flag_rules(wide, contract, parents, False, keys_from=rows)
            plan = _plan(flagged)
            assert {r.id: r[FAILED] for r in flagged.collect()} == {r.id: expect[r.id] for r in wide.collect()}
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        assert limit == "-1" or "SortMergeJoin" not in plan


def test_rules_are_judged_before_rows_meet_their_repeated_keys(spark):
    contract = Contract("t", 1, (ColumnSpec("id", "bigint", False), ColumnSpec("amount", "bigint"), ColumnSpec("note", "string")), ("id",),
                        rules={"amount_positive": "amount > 0", "note_short": "length(note) < 9"})
    rows = spark.createDataFrame([(1, 5, "a"), (1, -5, "b"), (2, None, "a note too long"), (None, 0, None), (None, 1, None)],
                                 "id long, amount long, note string")
    flagged = flag_rules(rows, contract)
    assert flagged.columns == ["id", "amount", "note", FAILED]
    got = sorted((r.id or 0, r.amount or 0, list(r[FAILED])) for r in flagged.collect())
    assert got == [(0, 0, ["amount_positive", "not_null:id"]), (0, 1, ["not_null:id"]), (1, -5, ["amount_positive", "duplicate_key"]),
                   (1, 5, ["duplicate_key"]), (2, 0, ["note_short"])]
    plan = flagged.select(FAILED)._jdf.queryExecution().optimizedPlan()
    while not plan.nodeName().startswith("Join"):
        plan = plan.children().apply(0)
    assert plan.children().apply(0).output().size() == 2  # the key and what the rules found, not the columns they read


def test_the_orders_of_a_large_fact_are_hashed_not_sorted(spark, monkeypatch):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before, partitions = spark.conf.get(key), session.shuffle_partitions(spark)
    expect = star.order_items(spark, SF_SMOKE).orderBy("order_item_id", *star.fact_sort_keys()).collect()
    spark.conf.set(key, "1k")
    try:
        with session.sized_shuffles(spark, session.SHUFFLE_BYTES * 40 + 1):
            assert session.shuffle_partitions(spark) == max(41, partitions)
            items = star.order_items(spark, SF_SMOKE)
            assert "ShuffledHashJoin" in _plan(items) and "SortMergeJoin" not in _plan(items)
            assert items.orderBy("order_item_id", *star.fact_sort_keys()).collect() == expect
        assert session.shuffle_partitions(spark) == partitions
        monkeypatch.setattr(session, "BUILD_BYTES", 1)  # too many orders for a partition: sorted
        assert "SortMergeJoin" in _plan(star.order_items(spark, SF_SMOKE))
    finally:
        spark.conf.set(key, before)


def test_layers_are_counted_in_one_row_per_key(spark):
    schema = "w int, k string, v long"
    source = spark.createDataFrame([(1, "a", 5), (1, "a", 6), (2, "a", 7), (2, "b", 8), (None, None, 9)], schema)
    topic = spark.createDataFrame([(1, "a", 5), (1, "a", 5), (2, "b", None), (3, "z", 99)], schema)
    found = windowed_reconcile([("source", source), ("topic", topic), ("bronze", topic.where("w = 1"))], "w", "k", "v")
    plan = _plan(found)
    assert "Exchange" not in plan and "FileScan parquet" in plan  # what is left to do is one row per window
    rows = {(r.time_window, r.layer): tuple(r)[2:] for r in found.collect()}
    assert len(rows) == 16 and ("3", "topic") not in rows
    assert rows["1", "source"] == (2, 1, 0, 0.0, 0.5, 0) and rows["1", "topic"] == (2, 1, 0, 0.0, 0.5, 1)
    assert rows["1", "silver"] == (1, 1, 0, 0.0, 0.0, 1) and rows["2", "bronze"] == (0, 0, 2, 1.0, None, None)
    assert rows["2", "topic"] == (1, 1, 1, 0.5, 0.0, None) and rows[None, "source"] == (1, 1, 0, 0.0, 0.0, 0)
    assert rows["all", "source"] == (5, 3, 0, 0.0, 0.4, 0) and rows["all", "topic"][:2] == (4, 3) and rows["all", "silver"][:2] == (1, 1)
    empty = source.limit(0)
    assert windowed_reconcile([("source", empty), ("topic", topic), ("bronze", topic)], "w", "k", "v").count() == 0
