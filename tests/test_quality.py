"""Contracts, quarantine, dedup, upsert and reconciliation semantics
(FIXTURES.md §3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.dedup import duplicate_stats, latest_per_key
from tessera.operators.upsert import upsert
from tessera.quality import validation as V
from tessera.quality.contracts import SOURCE_ORDER_ITEMS, STAR_CONTRACTS, ColumnSpec, Contract, classify_change
from tessera.quality.reconcile import layer_stats, reconcile, row_set_difference
from tessera.sources.incremental import bulk_polls, timestamp_id_window, timestamp_window

C = Contract("t", 1, (ColumnSpec("id", "bigint", False), ColumnSpec("qty", "int", False),
                      ColumnSpec("parent", "bigint")),
             ("id",), rules={"qty_positive": "qty > 0"}, foreign_keys={"parent": ("p", "pid")})


def test_schema_violations_one_of_each_kind():
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("qty", T.IntegerType()),
                           T.StructField("other", T.StringType())])
    kinds = sorted((r[1], r[2]) for r in V.schema_violations_list(C, schema))
    assert kinds == [("id", "type_mismatch"), ("other", "extra"), ("parent", "missing")]


def test_rules_and_quarantine_conservation(spark):
    rows = [(1, 5, 10), (2, None, 10), (3, 4, 99), (4, -1, 10), (4, 2, 10)]
    df = spark.createDataFrame(rows, "id bigint, qty int, parent bigint")
    parents = {"p": spark.createDataFrame([(10,)], "pid bigint")}
    flagged = V.flag_rules(df, C, parents)
    passed, quarantined = V.quarantine_split(flagged)
    got = {(r.id, r.qty): r[V.FAILED] for r in quarantined.collect()}
    assert got == {(2, None): ["not_null:qty"], (3, 4): ["fk:parent"],
                   (4, -1): ["duplicate_key", "qty_positive"], (4, 2): ["duplicate_key"]}
    assert [r.id for r in passed.collect()] == [1]
    assert passed.count() + quarantined.count() == df.count()
    assert "_dq_validated_at" in quarantined.columns


def test_conform_tolerant_cast(spark):
    df = spark.createDataFrame([("1", "x"), ("2", "3")], "id string, qty string")
    out = V.conform(df, C)
    types = dict(out.dtypes)
    assert types.pop(V.UNCASTABLE) == "array<struct<column:string,raw:string>>"
    assert types == {"id": "bigint", "qty": "int", "parent": "bigint"}
    assert [r.qty for r in out.orderBy("id").collect()] == [None, 3]


def test_contract_json_roundtrip_and_evolution():
    for c in STAR_CONTRACTS.values():
        assert Contract.from_json(c.to_json()) == c
    new = Contract("t", 2, (ColumnSpec("id", "bigint", False), ColumnSpec("qty", "bigint", False),
                            ColumnSpec("note", "string")), ("id",))
    changes = {(c, k) for c, _, k in classify_change(C, new)}
    assert changes == {("parent", "breaking"), ("note", "additive"), ("qty", "additive")}
    assert SOURCE_ORDER_ITEMS.key == ("order_item_id",)


def test_latest_per_key_newer_wins_and_tie_break(spark):
    rows = [("k1", 100, "a"), ("k1", 200, "b"), ("k2", 100, "x"), ("k2", 100, "y"), ("k3", None, "n")]
    df = spark.createDataFrame(rows, "k string, dt_update bigint, v string")
    out = {r.k: (r.dt_update, r.v) for r in latest_per_key(df, ["k"], ["dt_update", "v"]).collect()}
    assert out == {"k1": (200, "b"), "k2": (100, "y"), "k3": (None, "n")}


def test_bulk_polls_duplication_and_dedup(spark):
    src = spark.createDataFrame([(i, 1000 + i) for i in range(10)], "id bigint, dt_update bigint")
    polled = bulk_polls(src, 2).drop("_poll")
    st = duplicate_stats(polled, ["id"]).first()
    assert (st.total_rows, st.unique_keys) == (20, 10)
    stats = [layer_stats(src, "t", "source", ["id"], "dt_update"),
             layer_stats(polled, "t", "topic", ["id"], "dt_update"),
             layer_stats(latest_per_key(polled, ["id"], ["dt_update"]), "t", "silver", ["id"], "dt_update")]
    rec = {r.layer: (r.loss_rate, r.duplication_rate, r.lag_ms) for r in reconcile(stats).collect()}
    assert rec["topic"] == (0.0, 0.5, 0)
    assert rec["silver"] == (0.0, 0.0, 0)


def test_cursor_windows(spark):
    df = spark.createDataFrame([(1, 10), (2, 10), (3, 20), (4, 30)], "id int, v int")
    assert sorted(r.id for r in timestamp_window(df, "v", 10, 20).collect()) == [3]
    assert sorted(r.id for r in timestamp_id_window(df, "v", "id", 10, 1).collect()) == [2, 3, 4]
    plan = timestamp_window(df, "v", 10, 20)._jdf.queryExecution().optimizedPlan().toString()
    assert "10" in plan and "20" in plan


def test_upsert_replaces_and_inserts(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, dt bigint")
    batch = spark.createDataFrame([(2, "B", 5), (2, "B2", 6), (3, "c", 5)], "k int, v string, dt bigint")
    out = {r.k: (r.v, r.dt) for r in upsert(target, batch, ["k"], order_by=["dt"]).collect()}
    assert out == {1: ("a", 1), 2: ("B2", 6), 3: ("c", 5)}
    stamped = {r.k: r.dt for r in upsert(target, batch, ["k"], order_by=["dt"], stamp_col="dt",
                                         stamp_value=99).collect()}
    assert stamped == {1: 1, 2: 99, 3: 99}


def test_row_set_difference_multiplicity(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (3,)], "x int")
    got = sorted((r.side, r.x) for r in row_set_difference(a, b).collect())
    assert got == [("dest_only", 3), ("source_only", 1), ("source_only", 2)]


def test_pick_scoped_falls_back_to_all_candidates(spark):
    from tessera.operators.dimensions import pick_scoped
    items = spark.createDataFrame([(0, "A"), (1, "A"), (2, "B"), (3, None)], "id bigint, cat string")
    cands = spark.createDataFrame([("A", "a1"), ("A", "a2"), ("C", "c1")], "cat string, brand string")
    out = {r.id: r.pick for r in pick_scoped(items, cands, "cat", "brand", "id", "pick").collect()}
    # scoped: A -> [a1, a2]; B and NULL have none -> all brands [a1, a2, c1]
    assert out == {0: "a1", 1: "a2", 2: "c1", 3: "a1"}


def test_catalog_table_created_then_partition_reloaded(spark, scratch):
    from tessera.sinks.bronze import with_bronze_metadata
    from tessera.sinks.catalog import load_partitioned_table, table_exists
    name = "tessera_test_" + scratch.rsplit("-", 1)[1].lower()
    day1 = with_bronze_metadata(spark.range(4).withColumnRenamed("id", "k"), "2026-08-16")
    day2 = with_bronze_metadata(spark.range(2).withColumnRenamed("id", "k"), "2026-08-17")
    assert not table_exists(spark, name)
    assert load_partitioned_table(day1, name, f"{scratch}/t") == "created"
    assert load_partitioned_table(day2, name, f"{scratch}/t") == "reloaded"
    assert load_partitioned_table(day1, name, f"{scratch}/t") == "reloaded"
    counts = {str(r[0]): r[1] for r in spark.sql(
        f"SELECT _processing_date, COUNT(*) FROM {name} GROUP BY 1").collect()}
    assert counts == {"2026-08-16": 4, "2026-08-17": 2}


def test_distinct_counts_exact_and_approximate(spark):
    from tessera.quality.metrics import distinct_counts
    df = spark.range(0, 200_000).selectExpr("id % 50000 AS k")
    exact = {r.metric: r.distinct_values for r in distinct_counts([("k", df, "k")]).collect()}
    approx = {r.metric: r.distinct_values for r in distinct_counts([("k", df, "k")], approx=True).collect()}
    assert exact == {"k": 50000}
    assert abs(approx["k"] - 50000) / 50000 < 0.05
