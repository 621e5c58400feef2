"""Quality, change-capture and reconciliation plans: quarantine, silver
build, upsert, incremental cursors, bulk re-poll duplication, layer
reconciliation, quality metrics and coverage, wire-format decoding."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import standardize as S
from tessera.functions import wire
from tessera.operators.dedup import latest_per_key
from tessera.operators.upsert import upsert
from tessera.plans import register
from tessera.plans.analytics import LATEST_COLS, TABLE_ORDER, _LATEST_SQL, _money_out
from tessera.plans.oracle_star import with_star
from tessera.quality.contracts import SOURCE_ORDER_ITEMS, STAR_CONTRACTS, classify_change, contract_of
from tessera.quality.reconcile import layer_stats, windowed_reconcile
from tessera.quality.validation import FAILED, conform, flag_rules, quarantine_split, schema_violations, schema_violations_list
from tessera.session import scratch_path
from tessera.sinks import versioned
from tessera.sources import incremental, star

# --------------------------------------------------------------------------
# Oracle helpers: the contract rules rendered as DuckDB SQL


def _duck(expr: str) -> str:
    """Spark SQL rule -> DuckDB: ``x RLIKE 'p'`` -> ``regexp_matches(x, 'p')``."""
    return re.sub(r"(\w+) RLIKE ('[^']*')", r"regexp_matches(\1, \2)", expr)


def _qualify(expr: str, cols: list[str], alias: str) -> str:
    """Prefix bare column names of a rule (outside quotes) with ``alias``."""
    pieces = re.split(r"('[^']*')", expr)
    pat = re.compile(r"(?<![\w.])(" + "|".join(map(re.escape, cols)) + r")(?!\w)")
    return "".join(p if p.startswith("'") else pat.sub(rf"{alias}.\1", p) for p in pieces)


def _rules_list_sql(table: str, alias: str, dup_alias: str | None) -> str:
    """Comma-separated names of the failed rules, in name order (the order
    ``array_sort`` gives on the Spark side); '' when the row passes."""
    c = STAR_CONTRACTS[table]
    terms = [(f"not_null:{n}", f"{alias}.{n} IS NULL") for n in c.required]
    terms += [(r, f"NOT coalesce({_qualify(_duck(e), c.column_names, alias)}, true)") for r, e in c.rules.items()]
    if dup_alias:
        terms.append(("duplicate_key", f"{dup_alias}._dup"))
    for col, (ptable, pcol) in c.foreign_keys.items():
        terms.append((f"fk:{col}", f"{alias}.{col} IS NOT NULL AND NOT EXISTS "
                                   f"(SELECT 1 FROM {ptable} p WHERE p.{pcol} = {alias}.{col})"))
    cases = [f"CASE WHEN {cond} THEN '{name}' END" for name, cond in sorted(terms)]
    return "concat_ws(',', " + ", ".join(cases) + ")"


def _flagged_sql(table: str, source: str | None = None) -> str:
    """SELECT of ``table`` rows with their failed rules as text."""
    key = STAR_CONTRACTS[table].key
    src = source or table
    on = " AND ".join(f"t.{k} = d.{k}" for k in key)
    return (f"SELECT t.*, {_rules_list_sql(table, 't', 'd')} AS failed_rules FROM {src} t "
            f"LEFT JOIN (SELECT {', '.join(key)}, true AS _dup FROM {src} GROUP BY {', '.join(key)} "
            f"HAVING COUNT(*) > 1) d ON {on}")


def _parents(spark: SparkSession, sf_dir: str, table: str) -> dict[str, DataFrame]:
    return {p: star.calendar_keys(spark, sf_dir) if p == "calendar" else star.star_table(spark, sf_dir, p)
            for p, _ in STAR_CONTRACTS[table].foreign_keys.values()}


def _flag(spark: SparkSession, sf_dir: str, table: str, df: DataFrame | None = None,
          check_duplicates: bool = True, keys_from: DataFrame | None = None) -> DataFrame:
    df = df if df is not None else star.star_table(spark, sf_dir, table)
    return flag_rules(df, STAR_CONTRACTS[table], _parents(spark, sf_dir, table), check_duplicates, keys_from)


# --------------------------------------------------------------------------
# Quarantine


@register("quarantine_split", with_star(*TABLE_ORDER) + f"""
SELECT order_item_id, order_id, customer_id, product_id, dt_update, CAST(quantity AS DOUBLE) AS quantity, failed_rules
FROM ({_flagged_sql("order_items")}) f
WHERE failed_rules <> ''""")
def quarantine_split_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined fact rows with the names of the rules they fail."""
    _, quarantined = quarantine_split(_flag(spark, sf_dir, "order_items"))
    return quarantined.select("order_item_id", "order_id", "customer_id", "product_id", "dt_update", F.col("quantity").cast("double").alias("quantity"),
                              F.array_join(FAILED, ",").alias("failed_rules"))


@register("quarantine_summary", with_star(*TABLE_ORDER) + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS input_rows, "
    f"CAST(SUM(CASE WHEN failed_rules = '' THEN 1 ELSE 0 END) AS BIGINT) AS passed_rows, "
    f"CAST(SUM(CASE WHEN failed_rules <> '' THEN 1 ELSE 0 END) AS BIGINT) AS quarantined_rows "
    f"FROM ({_flagged_sql(t)}) f" for t in TABLE_ORDER) + "\nORDER BY table_name")
def quarantine_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per table: input = passed + quarantined (no row is dropped)."""
    frames = []
    for t in TABLE_ORDER:
        failed = F.size(FAILED) > 0
        frames.append(_flag(spark, sf_dir, t).agg(
            F.count(F.lit(1)).alias("input_rows"),
            F.sum(F.when(failed, 0).otherwise(1)).cast("bigint").alias("passed_rows"),
            F.sum(F.when(failed, 1).otherwise(0)).cast("bigint").alias("quarantined_rows"),
        ).select(F.lit(t).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, frames).orderBy("table_name")


@register("quarantine_rule_counts", with_star(*TABLE_ORDER) + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, rule, COUNT(*) AS failed_rows FROM "
    f"(SELECT unnest(string_split(failed_rules, ',')) AS rule FROM ({_flagged_sql(t)}) f "
    f"WHERE failed_rules <> '') r GROUP BY rule" for t in TABLE_ORDER) + "\nORDER BY table_name, rule")
def quarantine_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.quality.validation import rule_counts
    frames = [rule_counts(_flag(spark, sf_dir, t), t) for t in TABLE_ORDER]
    return reduce(DataFrame.unionByName, frames).orderBy("table_name", "rule")


# --------------------------------------------------------------------------
# Silver build: dedup latest per key, standardize, conform, validate


def _order_all(table: str, cols: list[str]) -> list[str]:
    c = STAR_CONTRACTS[table]
    first = [c.version_column] if c.version_column else []
    return first + [x for x in cols if x not in c.key and x not in first]


def silver_table(spark: SparkSession, sf_dir: str, table: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(bronze, passed silver rows, quarantined rows) for one table."""
    bronze = star.star_table(spark, sf_dir, table)
    c = STAR_CONTRACTS[table]
    latest = latest_per_key(bronze, list(c.key), _order_all(table, bronze.columns))
    cleaned = conform(S.trim_strings(latest), c)
    passed, quarantined = quarantine_split(_flag(spark, sf_dir, table, cleaned, check_duplicates=False, keys_from=conform(S.trim_strings(bronze), c)))
    return bronze, passed, quarantined


def _silver_sql(t: str) -> str:
    c = STAR_CONTRACTS[t]
    order = ", ".join(f"{x} DESC" for x in _order_all(t, c.column_names))
    latest = (f"(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(c.key)} "
              f"ORDER BY {order}) AS rn FROM {t}) z WHERE rn = 1)")
    rules = _rules_list_sql(t, "s", None)
    return (f"SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM {t}) AS rows_in, "
            f"(SELECT COUNT(*) FROM {t}) - COUNT(*) AS duplicates_dropped, "
            f"CAST(SUM(CASE WHEN {rules} <> '' THEN 1 ELSE 0 END) AS BIGINT) AS quarantined, "
            f"CAST(SUM(CASE WHEN {rules} = '' THEN 1 ELSE 0 END) AS BIGINT) AS rows_out "
            f"FROM {latest} s")


@register("silver_build_counts", with_star(*TABLE_ORDER) + "\nUNION ALL\n".join(
    _silver_sql(t) for t in TABLE_ORDER) + "\nORDER BY table_name")
def silver_build_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All counts of a table come from one pass: the dedup aggregate also
    counts the rows of each key, and one conditional aggregate sums up."""
    frames = []
    for t in TABLE_ORDER:
        c = STAR_CONTRACTS[t]
        bronze = star.star_table(spark, sf_dir, t)
        latest = latest_per_key(bronze, list(c.key), _order_all(t, bronze.columns), count_col="_versions")
        flagged = _flag(spark, sf_dir, t, conform(S.trim_strings(latest), c), check_duplicates=False,
                        keys_from=conform(S.trim_strings(bronze), c))
        failed = F.size(FAILED) > 0
        frames.append(flagged.agg(
            F.coalesce(F.sum("_versions"), F.lit(0)).cast("bigint").alias("rows_in"),
            F.coalesce(F.sum(F.col("_versions") - 1), F.lit(0)).cast("bigint").alias("duplicates_dropped"),
            F.count_if(failed).alias("quarantined"), F.count_if(~failed).alias("rows_out"),
        ).select(F.lit(t).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, frames).orderBy("table_name")


def _silver_rows_sql(t: str, passed: bool) -> str:
    c = STAR_CONTRACTS[t]
    order = ", ".join(f"{x} DESC" for x in _order_all(t, c.column_names))
    latest = (f"(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(c.key)} "
              f"ORDER BY {order}) AS rn FROM {t}) z WHERE rn = 1)")
    return f"FROM {latest} s WHERE {_rules_list_sql(t, 's', None)} {'=' if passed else '<>'} ''"


@register("silver_order_items", with_star(*TABLE_ORDER) + f"""
SELECT order_item_id, order_id, customer_id, product_id, supplier_id, date_code, CAST(quantity AS DOUBLE) AS quantity,
       CAST(total_price AS DOUBLE) AS total_price, CAST(discount AS DOUBLE) AS discount, CAST(tax AS DOUBLE) AS tax,
       return_flag, line_status, dt_update
{_silver_rows_sql("order_items", True)}""")
def silver_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver fact itself: latest row per key, cleaned, rules passed."""
    return _money_out(silver_table(spark, sf_dir, "order_items")[1]).select(*LATEST_COLS)


@register("silver_customers", with_star(*TABLE_ORDER) + f"""
SELECT customer_id, phone, country_code, country, state, city
{_silver_rows_sql("customers", True)}""")
def silver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_table(spark, sf_dir, "customers")[1]


@register("silver_products", with_star(*TABLE_ORDER) + f"""
SELECT product_id, product_name, brand_code, category_code, CAST(price AS DOUBLE) AS price, size
{_silver_rows_sql("products", True)}""")
def silver_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = silver_table(spark, sf_dir, "products")[1]
    return p.withColumn("price", F.col("price").cast("double"))


@register("dq_schema_violations", """
SELECT * FROM (VALUES
  ('order_items', 'discount', 'extra', NULL, 'decimal(4,2)', 'additive'),
  ('order_items', 'line_status', 'extra', NULL, 'string', 'additive'),
  ('order_items', 'return_flag', 'extra', NULL, 'string', 'additive'),
  ('order_items', 'supplier_id', 'extra', NULL, 'bigint', 'additive'),
  ('order_items', 'tax', 'extra', NULL, 'decimal(4,2)', 'additive'),
  ('order_items', 'unit_price', 'missing', 'decimal(10,2)', NULL, 'breaking'),
  ('order_items', 'customer_id', 'type_mismatch', 'string', 'bigint', 'breaking'),
  ('order_items', 'order_id', 'type_mismatch', 'string', 'bigint', 'breaking'),
  ('order_items', 'product_id', 'type_mismatch', 'string', 'bigint', 'breaking'),
  ('order_items', 'quantity', 'type_mismatch', 'int', 'decimal(12,2)', 'breaking'),
  ('order_items', 'total_price', 'type_mismatch', 'decimal(10,2)', 'decimal(12,2)', 'additive')
) v(table_name, column_name, violation, expected_type, actual_type, change)
WHERE EXISTS (SELECT 1 FROM lineitem)""")
def dq_schema_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived fact against the contract of its source table, each
    difference with its class under the evolution policy."""
    items = star.order_items(spark, sf_dir)
    found = schema_violations(spark, SOURCE_ORDER_ITEMS, items.schema)
    kind = {name: k for name, change, k in classify_change(SOURCE_ORDER_ITEMS, contract_of("order_items", items.schema, SOURCE_ORDER_ITEMS))
            if change not in ("nullable", "required")}
    change = spark.createDataFrame(sorted(kind.items()), "column_name string, change string")
    return found.join(change, "column_name").select(*found.columns, "change")


# --------------------------------------------------------------------------
# Upsert and incremental cursors on the fact table

# 1998-06-01 00:00:00 UTC: rows up to it form the target, later rows the batch.
UPSERT_SPLIT_MS = 896659200000


@register("keyed_upsert", with_star("order_items") + _LATEST_SQL)
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert of the later changes onto the earlier snapshot: must equal the
    latest version of every key over the whole history."""
    items = star.order_items(spark, sf_dir)
    keys, order = ["order_item_id"], star.fact_sort_keys()
    target = latest_per_key(items.where(F.col("dt_update") <= UPSERT_SPLIT_MS), keys, order)
    batch = items.where(F.col("dt_update") > UPSERT_SPLIT_MS)
    return _money_out(upsert(target, batch, keys, order)).select(*LATEST_COLS)


# Bounds of the cursor polls on the raw version column (ship date), and the
# last id delivered at the lower one.
CURSOR_LOW, CURSOR_HIGH = "1996-01-01 00:00:00", "1996-03-01 00:00:00"
CURSOR_LAST_ID = 7500 * 100

_CURSOR_COLS = "order_item_id, order_id, product_id, CAST(quantity AS DOUBLE) AS quantity, CAST(total_price AS DOUBLE) AS total_price, dt_update"


def _cursor_out(df: DataFrame) -> DataFrame:
    return _money_out(df).select("order_item_id", "order_id", "product_id", "quantity", "total_price", "dt_update")


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _polled(spark: SparkSession, sf_dir: str, pick) -> DataFrame:
    """Fact lines of the raw rows that ``pick`` chooses: its bounds are on the
    stored version column, so they are pushed to the scan."""
    return star.lines_of(pick(star.read_table(spark, sf_dir, "lineitem")))


@register("cursor_timestamp", with_star("order_lines") + f"""
SELECT {_CURSOR_COLS} FROM order_lines
WHERE dt_update > epoch_ms(TIMESTAMP '{CURSOR_LOW}') AND dt_update <= epoch_ms(TIMESTAMP '{CURSOR_HIGH}')""")
def cursor_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cursor_out(_polled(spark, sf_dir, lambda raw: incremental.timestamp_window(
        raw, "l_shipdate", _ntz(CURSOR_LOW), _ntz(CURSOR_HIGH))))


# order line as one number: the incrementing id of the timestamp+id cursor
_LINE_ID = "l_orderkey * 100 + l_linenumber"


@register("cursor_timestamp_id", with_star("order_lines") + f"""
SELECT {_CURSOR_COLS} FROM (SELECT *, order_id * 100 + CAST(split_part(order_item_id, '-', 2) AS BIGINT) AS line_id FROM order_lines) t
WHERE (dt_update > epoch_ms(TIMESTAMP '{CURSOR_LOW}') OR (dt_update = epoch_ms(TIMESTAMP '{CURSOR_LOW}') AND line_id > {CURSOR_LAST_ID}))
  AND dt_update <= epoch_ms(TIMESTAMP '{CURSOR_HIGH}')""")
def cursor_timestamp_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cursor_out(_polled(spark, sf_dir, lambda raw: incremental.timestamp_id_window(
        raw.withColumn("line_id", F.expr(_LINE_ID)), "l_shipdate", "line_id", _ntz(CURSOR_LOW), CURSOR_LAST_ID, _ntz(CURSOR_HIGH))))


@register("cursor_resume", with_star("order_lines") + f"""
SELECT {_CURSOR_COLS}, CASE WHEN dt_update <= epoch_ms(TIMESTAMP '{CURSOR_LOW}') THEN 1 ELSE 2 END AS poll FROM order_lines
WHERE dt_update <= epoch_ms(TIMESTAMP '{CURSOR_HIGH}')""")
def cursor_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two polls from a stored mark: read the mark, pull what lies after it up
    to the poll's upper bound, and commit rows and new mark as one version.
    Before the second poll, the same poll writes its rows and dies short of
    the commit.  Every row is delivered once, rows that share a version and
    an id included."""
    sink = scratch_path(spark, "cursor")
    for poll, high, dies in ((1, CURSOR_LOW, False), (2, CURSOR_HIGH, True), (2, CURSOR_HIGH, False)):
        version, last_id = versioned.load(spark, sink).marks.get("lineitem", ("0001-01-01 00:00:00", -1))
        rows = incremental.timestamp_id_window(star.read_table(spark, sf_dir, "lineitem").withColumn("line_id", F.expr(_LINE_ID)),
                                               "l_shipdate", "line_id", _ntz(version), int(last_id), _ntz(high))
        rows = rows.withColumn("poll", F.lit(poll))
        if dies:
            versioned.stage(rows, sink, F.col("poll").cast("string"))
            continue
        mark = incremental.high_water_mark(rows, "l_shipdate", "line_id")
        if mark is not None:
            versioned.append(rows, sink, "poll", {"lineitem": [str(mark[0]), mark[1]]})
    back = versioned.read(spark, sink)
    return _money_out(star.lines_of(back, "poll")).select("order_item_id", "order_id", "product_id", "quantity", "total_price", "dt_update", "poll")


@register("bulk_vs_timestamp", with_star("order_lines") + """
, s AS (SELECT COUNT(*) AS n, COUNT(DISTINCT order_item_id) AS k FROM order_lines)
SELECT 'bulk' AS mode, 2 * n AS rows, k AS distinct_keys, 1 - k / (2 * n) AS duplication_rate FROM s
UNION ALL SELECT 'bulk_deduplicated', k, k, 1 - k / k FROM s
UNION ALL SELECT 'timestamp', n, k, 1 - k / n FROM s
ORDER BY mode""")
def bulk_vs_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplication from re-reading the whole table every poll (two polls)
    against timestamp-mode polls, and after key dedup of the bulk feed."""
    lines = star.order_lines(spark, sf_dir)
    key = ["order_item_id"]
    bulk = incremental.bulk_polls(lines, 2)
    ts = incremental.timestamp_polls(lines, "dt_update", [-(2 ** 63), UPSERT_SPLIT_MS, None])
    dedup = latest_per_key(bulk.drop("_poll"), key, star.fact_sort_keys())
    frames = [layer_stats(df, "order_items", mode, key)
              for mode, df in (("bulk", bulk), ("timestamp", ts), ("bulk_deduplicated", dedup))]
    out = reduce(DataFrame.unionByName, frames)
    return out.select(F.col("layer").alias("mode"), "rows", "distinct_keys",
                      (1 - F.col("distinct_keys") / F.col("rows")).alias("duplication_rate")).orderBy("mode")


# --------------------------------------------------------------------------
# Four-point reconciliation: source -> topic -> bronze -> silver
#
# Faults of the feed, as rules on the fact, so that there is something to
# find: one ship month never reaches the topic, another month's returned lines
# arrive cut short, and bronze has not loaded the newest versions yet.
LOST_MONTH, CUT_MONTH = 199706, 199707
LOADED_UNTIL_MS = 988675200000  # 2001-05-01 00:00:00 UTC
_LOST = f"month = {LOST_MONTH}"
_CUT = f"month = {CUT_MONTH} AND return_flag = 'R'"
_LOADED = f"dt_update <= {LOADED_UNTIL_MS}"


def _fact_layers(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    """(layer, frame of month, key, version, n) of the fact.  Topic (two bulk
    polls of change envelopes) and bronze (the envelopes that parse and are
    loaded) are written and read back; silver is bronze's rows by key."""
    root = scratch_path(spark, "reconcile")
    lines = star.order_lines(spark, sf_dir).withColumn("month", F.floor(F.col("date_code") / 100).cast("int"))
    body = wire.envelope_value([c for c in lines.columns if c != "month"], "c", "dt_update")
    value = F.when(F.expr(_CUT), F.left(body, F.lit(40))).otherwise(body)
    # the message is made once and then polled twice: as an element it isn't computed per poll
    sent = lines.where(f"NOT ({_LOST})").select("month", "order_item_id", "dt_update", F.posexplode(F.array_repeat(value, 2)).alias("poll", "value"))
    sent.write.parquet(f"{root}/topic")
    topic = spark.read.parquet(f"{root}/topic")
    rows = wire.unwrap(topic, "value", lines.drop("month").schema).where(F.col("order_item_id").isNotNull() & F.expr(_LOADED))
    rows.drop("__deleted", "__op").write.parquet(f"{root}/bronze")
    bronze = spark.read.parquet(f"{root}/bronze").withColumn("month", F.floor(F.col("date_code") / 100).cast("int"))
    return [("source", lines), ("topic", topic), ("bronze", bronze)]


def _recon_sql() -> str:
    rules = {"source": "true", "topic": f"NOT ({_LOST})", "bronze": f"NOT ({_LOST}) AND NOT ({_CUT}) AND {_LOADED}"}
    parts = []
    for layer, rule in rules.items():
        for window in ("CAST(month AS VARCHAR)", "'all'"):
            copies = 1 if layer == "source" else 2
            parts.append(f"SELECT '{layer}' AS layer, {window} AS time_window, {copies} * COUNT(*) AS row_count, "
                         f"COUNT(DISTINCT order_item_id) AS distinct_keys, MAX(dt_update) AS version FROM f WHERE {rule} GROUP BY 2")
    return f""", f AS (SELECT *, date_code // 100 AS month FROM order_lines),
l AS ({' UNION ALL '.join(parts)}),
a AS (SELECT * FROM l UNION ALL SELECT 'silver', time_window, distinct_keys, distinct_keys, version FROM l WHERE layer = 'bronze'),
w AS (SELECT s.time_window, n.layer, coalesce(a.row_count, 0) AS row_count, coalesce(a.distinct_keys, 0) AS distinct_keys,
             s.distinct_keys AS source_keys, s.version AS source_version, a.version
      FROM l s CROSS JOIN (VALUES ('source'), ('topic'), ('bronze'), ('silver')) n(layer)
      LEFT JOIN a ON a.layer = n.layer AND a.time_window = s.time_window WHERE s.layer = 'source')
SELECT time_window, layer, row_count, distinct_keys, source_keys - distinct_keys AS lost_keys,
       1 - distinct_keys / source_keys AS loss_rate,
       CASE WHEN row_count > 0 THEN 1 - distinct_keys / row_count END AS duplication_rate, source_version - version AS lag_ms
FROM w ORDER BY time_window, layer"""


@register("reconciliation", with_star("order_lines") + _recon_sql())
def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact through its four layers, per ship month and over all: rows,
    keys, keys lost against the source, loss and duplication rates, lag of the
    newest version.  One row per (layer, month, key) is aggregated once and
    feeds both the months and the whole."""
    return windowed_reconcile(_fact_layers(spark, sf_dir), "month", "order_item_id", "dt_update") \
        .orderBy("time_window", "layer")


# The other star tables, which have no version date.  Rules for their faults:
# some customers never reach the topic, some products arrive cut short.
DIMENSION_FAULTS = {"customers": ("customer_id % 50 = 7", "false"), "products": ("false", "size <= 5")}
_DIMENSIONS = [t for t in TABLE_ORDER if t != "order_items"]


def _dimension_layers(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    """(layer, frame of table_name, key, version) of all tables but the fact;
    one topic and one bronze, written and read back."""
    root = scratch_path(spark, "reconcile_dimensions")
    frames = {t: star.star_table(spark, sf_dir, t) for t in _DIMENSIONS}

    def keyed(df: DataFrame, t: str) -> list:
        return [F.lit(t).alias("table_name"), F.col(star.primary_key(t)[0]).cast("string").alias("key"),
                F.lit(None).cast("bigint").alias("version")]

    sent, source = [], []
    for t, df in frames.items():
        lost, cut = DIMENSION_FAULTS.get(t, ("false", "false"))
        body = wire.envelope_value(df.columns)
        source.append(df.select(*keyed(df, t)))
        sent.append(df.where(f"NOT ({lost})").select(
            *keyed(df, t), F.when(F.expr(cut), F.left(body, F.lit(40))).otherwise(body).alias("value"),
            F.explode(F.sequence(F.lit(1), F.lit(2))).alias("poll")))
    reduce(DataFrame.unionByName, sent).write.parquet(f"{root}/topic")
    topic = spark.read.parquet(f"{root}/topic")
    loaded = [wire.unwrap(topic.where(F.col("table_name") == t), "value", df.schema).select(*keyed(df, t)) for t, df in frames.items()]
    reduce(DataFrame.unionByName, loaded).where("key IS NOT NULL").write.parquet(f"{root}/bronze")
    return [("source", reduce(DataFrame.unionByName, source)), ("topic", topic), ("bronze", spark.read.parquet(f"{root}/bronze"))]


def _dimension_recon_sql() -> str:
    keys = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST({star.primary_key(t)[0]} AS VARCHAR) AS key, "
        f"{DIMENSION_FAULTS.get(t, ('false', 'false'))[0]} AS lost, {DIMENSION_FAULTS.get(t, ('false', 'false'))[1]} AS cut FROM {t}"
        for t in _DIMENSIONS)
    counts = " UNION ALL ".join(
        f"SELECT table_name, '{layer}' AS layer, {copies} AS row_count, COUNT(DISTINCT key) AS distinct_keys FROM k WHERE {rule} GROUP BY 1"
        for layer, copies, rule in (("source", "COUNT(*)", "true"), ("topic", "2 * COUNT(*)", "NOT lost"),
                                    ("bronze", "2 * COUNT(*)", "NOT lost AND NOT cut"),
                                    ("silver", "COUNT(DISTINCT key)", "NOT lost AND NOT cut")))
    return f""", k AS ({keys}), l AS ({counts}),
w AS (SELECT s.table_name, n.layer, coalesce(l.row_count, 0) AS row_count, coalesce(l.distinct_keys, 0) AS distinct_keys,
             s.distinct_keys AS source_keys
      FROM l s CROSS JOIN (VALUES ('source'), ('topic'), ('bronze'), ('silver')) n(layer)
      LEFT JOIN l ON l.layer = n.layer AND l.table_name = s.table_name WHERE s.layer = 'source')
SELECT table_name, 'all' AS time_window, layer, row_count, distinct_keys, source_keys - distinct_keys AS lost_keys,
       1 - distinct_keys / source_keys AS loss_rate,
       CASE WHEN row_count > 0 THEN 1 - distinct_keys / row_count END AS duplication_rate, CAST(NULL AS BIGINT) AS lag_ms
FROM w ORDER BY table_name, layer"""


@register("reconciliation_dimensions", with_star(*_DIMENSIONS) + _dimension_recon_sql())
def reconciliation_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All star tables but the fact (``reconciliation``) through their four
    layers: one row per table and layer, over all rows (they have no version
    date, so no lag).  One aggregation counts all tables."""
    found = windowed_reconcile(_dimension_layers(spark, sf_dir), "table_name", "key", "version")
    # a window of this pass is a table; its 'all' mixes tables
    return found.where("time_window != 'all'").select(
        F.col("time_window").alias("table_name"), F.lit("all").alias("time_window"), *found.columns[1:]).orderBy("table_name", "layer")


# --------------------------------------------------------------------------
# Quality metrics (five dimensions) and coverage

THRESHOLDS = {  # dimension -> (OK at or above, WARN at or above); freshness in hours, lower is better
    "completeness": (0.99, 0.95),
    "uniqueness": (1.0, 0.99),
    "schema_conformity": (1.0, 0.8),
    "domain_validity": (0.99, 0.95),
    "freshness_lag_hours": (24.0, 72.0),
}


def _schema_conformity(spark, sf_dir, t) -> float:
    c = STAR_CONTRACTS[t]
    df = star.star_table(spark, sf_dir, t)
    return 1.0 - len(schema_violations_list(c, df.schema)) / len(c.columns)


def _metrics_frame(spark: SparkSession, sf_dir: str, t: str) -> DataFrame:
    c = STAR_CONTRACTS[t]
    df = star.star_table(spark, sf_dir, t)
    nulls = sum((F.when(F.col(n).isNull(), 1).otherwise(0) for n in c.required), F.lit(0))
    domain_ok = F.lit(True)
    for e in c.rules.values():
        domain_ok = domain_ok & F.coalesce(F.expr(e), F.lit(True))
    per_key = df.groupBy(*c.key).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(nulls).alias("_nulls"),
        F.sum(F.when(domain_ok, 1).otherwise(0)).alias("_ok"),
        (F.max(c.version_column) if c.version_column else F.lit(None).cast("bigint")).alias("_v"))
    s = per_key.agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("keys"),
                    F.sum("_nulls").alias("nulls"), F.sum("_ok").alias("ok"), F.max("_v").alias("v"))
    n_req = len(c.required)
    conf = _schema_conformity(spark, sf_dir, t)
    metrics = [
        ("completeness", 1 - F.col("nulls") / (F.col("rows") * n_req) if n_req else F.lit(1.0)),
        ("uniqueness", F.col("keys") / F.col("rows")),
        ("schema_conformity", F.lit(conf)),
        ("domain_validity", F.col("ok") / F.col("rows")),
    ]
    if c.version_column:
        # the newest version (epoch millis); ``dq_metrics_frame`` turns it
        # into the lag behind the newest version anywhere in the star
        metrics.append(("freshness_lag_hours", F.col("v")))
    # one wide summary row per table, unpivoted: the aggregation runs once
    wide = s.select(F.lit(t).alias("table_name"),
                    *[F.when(F.col("rows") > 0, v).cast("double").alias(d) for d, v in metrics])
    return wide.unpivot("table_name", [d for d, _ in metrics], "dimension", "value")


def _status(col="value", dim="dimension"):
    expr = None
    for d, (ok, warn) in THRESHOLDS.items():
        if d == "freshness_lag_hours":
            s = F.when(F.col(col) <= ok, "OK").when(F.col(col) <= warn, "WARN").otherwise("FAIL")
        else:
            s = F.when(F.col(col) >= ok, "OK").when(F.col(col) >= warn, "WARN").otherwise("FAIL")
        expr = F.when(F.col(dim) == d, s) if expr is None else expr.when(F.col(dim) == d, s)
    return expr


def dq_metrics_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window
    m = reduce(DataFrame.unionByName, [_metrics_frame(spark, sf_dir, t) for t in TABLE_ORDER])
    fresh = F.col("dimension") == "freshness_lag_hours"
    newest = F.max(F.when(fresh, F.col("value"))).over(Window.partitionBy())  # over the few summary rows
    m = m.withColumn("value", F.when(fresh, (newest - F.col("value")) / 3600000.0).otherwise(F.col("value")))
    return m.withColumn("status", F.when(F.col("value").isNull(), "FAIL").otherwise(_status()))


def _metrics_sql(spark_free_conformity: dict[str, float]) -> str:
    parts = []
    versioned = [(t, STAR_CONTRACTS[t].version_column) for t in TABLE_ORDER if STAR_CONTRACTS[t].version_column]
    star_newest = "(SELECT max(x) FROM (" + " UNION ALL ".join(
        f"SELECT max({v}) AS x FROM {t}" for t, v in versioned) + ") nv)"
    for t in TABLE_ORDER:
        c = STAR_CONTRACTS[t]
        nulls = " + ".join(f"CASE WHEN {n} IS NULL THEN 1 ELSE 0 END" for n in c.required) or "0"
        dom = " AND ".join(f"coalesce({_duck(e)}, true)" for e in c.rules.values()) or "true"
        key = ", ".join(c.key)
        newest = f"max({c.version_column})" if c.version_column else "NULL"
        base = (f"(SELECT COUNT(*) AS rows, (SELECT COUNT(*) FROM (SELECT DISTINCT {key} FROM {t}) d) AS keys, "
                f"SUM({nulls}) AS nulls, SUM(CASE WHEN {dom} THEN 1 ELSE 0 END) AS ok, {newest} AS v FROM {t})")
        n_req = len(c.required)
        dims = [("completeness", f"1 - nulls / (rows * {n_req})"), ("uniqueness", "keys / rows"),
                ("schema_conformity", repr(spark_free_conformity[t])), ("domain_validity", "ok / rows")]
        if c.version_column:
            dims.append(("freshness_lag_hours", f"({star_newest} - v) / 3600000.0"))
        for d, v in dims:
            parts.append(f"SELECT '{t}' AS table_name, '{d}' AS dimension, CAST({v} AS DOUBLE) AS value FROM {base} b")
    body = "\nUNION ALL\n".join(parts)
    status = "CASE " + " ".join(
        (f"WHEN dimension = '{d}' THEN CASE WHEN value <= {ok} THEN 'OK' WHEN value <= {warn} THEN 'WARN' ELSE 'FAIL' END"
         if d == "freshness_lag_hours" else
         f"WHEN dimension = '{d}' THEN CASE WHEN value >= {ok} THEN 'OK' WHEN value >= {warn} THEN 'WARN' ELSE 'FAIL' END")
        for d, (ok, warn) in THRESHOLDS.items()) + " END"
    return f"SELECT table_name, dimension, value, {status} AS status FROM ({body}) m"


# Every star table conforms to its contract column for column (checked by
# tests/test_quality.py), so the oracle's schema conformity is 1.0.
_CONFORMITY = {t: 1.0 for t in TABLE_ORDER}


@register("dq_metrics", with_star(*TABLE_ORDER) + _metrics_sql(_CONFORMITY) + "\nORDER BY table_name, dimension")
def dq_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq_metrics_frame(spark, sf_dir).orderBy("table_name", "dimension")


@register("dq_coverage", with_star(*TABLE_ORDER) + f"""
, m AS ({_metrics_sql(_CONFORMITY)}),
per AS (SELECT table_name, COUNT(DISTINCT dimension) AS dimensions_measured FROM m
        WHERE value IS NOT NULL GROUP BY table_name)
SELECT table_name, dimensions_measured, dimensions_measured >= 4 AS covered,
       CAST(SUM(CASE WHEN dimensions_measured >= 4 THEN 1 ELSE 0 END) OVER () AS DOUBLE) / COUNT(*) OVER () AS coverage,
       CASE WHEN CAST(SUM(CASE WHEN dimensions_measured >= 4 THEN 1 ELSE 0 END) OVER () AS DOUBLE) / COUNT(*) OVER () >= 0.95
            THEN 'OK' ELSE 'FAIL' END AS status
FROM per ORDER BY table_name""")
def dq_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of tables measured on at least 4 of the 5 dimensions (target 95 %)."""
    from pyspark.sql import Window
    m = dq_metrics_frame(spark, sf_dir).where(F.col("value").isNotNull())
    per = m.groupBy("table_name").agg(F.countDistinct("dimension").alias("dimensions_measured"))
    w = Window.partitionBy()  # over six summary rows only
    covered = F.col("dimensions_measured") >= 4
    share = F.sum(F.when(covered, 1).otherwise(0)).over(w).cast("double") / F.count(F.lit(1)).over(w)
    return per.select("table_name", "dimensions_measured", covered.alias("covered"), share.alias("coverage"),
                      F.when(share >= 0.95, "OK").otherwise("FAIL").alias("status")).orderBy("table_name")


# --------------------------------------------------------------------------
# Expected vs actual row counts (source-of-truth tables against the star)


@register("expected_vs_actual_counts", with_star(*TABLE_ORDER) + """
, e AS (
  SELECT 'brands' AS table_name, (SELECT COUNT(*) FROM (SELECT DISTINCT p_brand, p_type FROM part) x) AS expected_rows
  UNION ALL SELECT 'calendar', (SELECT CAST(max(CAST(l_shipdate AS DATE)) - min(CAST(l_shipdate AS DATE)) + 1 AS BIGINT) FROM lineitem)
  UNION ALL SELECT 'category', (SELECT COUNT(DISTINCT p_type) FROM part)
  UNION ALL SELECT 'customers', (SELECT COUNT(*) FROM customer)
  UNION ALL SELECT 'order_items', (SELECT COUNT(*) FROM lineitem)
  UNION ALL SELECT 'products', (SELECT COUNT(*) FROM part)),
a AS (
  SELECT 'brands' AS table_name, COUNT(*) AS row_count FROM brands
  UNION ALL SELECT 'calendar', COUNT(*) FROM calendar
  UNION ALL SELECT 'category', COUNT(*) FROM category
  UNION ALL SELECT 'customers', COUNT(*) FROM customers
  UNION ALL SELECT 'order_items', COUNT(*) FROM order_items
  UNION ALL SELECT 'products', COUNT(*) FROM products)
SELECT e.table_name, e.expected_rows, a.row_count,
       CASE WHEN a.row_count IS NULL THEN 'MISSING' WHEN a.row_count = e.expected_rows THEN 'MATCH' ELSE 'MISMATCH' END AS "check"
FROM e LEFT JOIN a ON e.table_name = a.table_name ORDER BY e.table_name""")
def expected_vs_actual_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.quality.metrics import expected_vs_actual, row_counts
    part = star.read_table(spark, sf_dir, "part")
    li = star.read_table(spark, sf_dir, "lineitem")
    one = lambda name, df: df.select(F.lit(name).alias("table_name"), F.col("n").cast("bigint").alias("expected_rows"))
    expected = reduce(DataFrame.unionByName, [
        one("brands", part.select("p_brand", "p_type").distinct().agg(F.count(F.lit(1)).alias("n"))),
        one("calendar", li.agg((F.datediff(F.max(F.to_date("l_shipdate")), F.min(F.to_date("l_shipdate"))) + 1)
                               .alias("n"))),
        one("category", part.agg(F.countDistinct("p_type").alias("n"))),
        one("customers", star.read_table(spark, sf_dir, "customer").agg(F.count(F.lit(1)).alias("n"))),
        one("order_items", li.agg(F.count(F.lit(1)).alias("n"))),
        one("products", part.agg(F.count(F.lit(1)).alias("n"))),
    ])
    actual = row_counts({n: star.star_table(spark, sf_dir, n) for n in TABLE_ORDER})
    return expected_vs_actual(actual, expected).select("table_name", "expected_rows", "row_count", "check") \
        .orderBy("table_name")


# --------------------------------------------------------------------------
# Wire formats: change envelopes, decimals as base64 bytes, epoch days


@register("envelope_roundtrip", with_star("order_lines") + """
SELECT order_item_id, order_id, product_id, supplier_id, date_code, CAST(quantity AS DOUBLE) AS quantity,
       CAST(total_price AS DOUBLE) AS total_price, CAST(discount AS DOUBLE) AS discount,
       CAST(tax AS DOUBLE) AS tax, return_flag, line_status, dt_update, 'c' AS op
FROM order_lines""")
def envelope_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows -> JSON change envelopes -> after-images, typed by the schema."""
    lines = star.order_lines(spark, sf_dir)
    env = wire.envelope(lines, "c", "dt_update")
    back = wire.unwrap(env, "value", lines.schema)
    return _money_out(back.where(~F.col("__deleted"))).withColumnRenamed("__op", "op").drop("__deleted")


@register("wire_decimal_products", with_star("products") + """
, u AS (SELECT product_id, price, CAST(round(price * 100) AS BIGINT) AS unscaled FROM products),
h AS (SELECT product_id, price, CASE WHEN length(hex(unscaled)) % 2 = 1 THEN '0' || hex(unscaled)
                                     ELSE hex(unscaled) END AS hx FROM u)
SELECT product_id, CAST(price AS DOUBLE) AS price,
       to_base64(unhex(CASE WHEN substr(hx, 1, 1) IN ('8','9','A','B','C','D','E','F') THEN '00' || hx
                            ELSE hx END)) AS wire_price,
       CAST(price AS DOUBLE) AS decoded_price
FROM h""")
def wire_decimal_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices encoded as the JSON converter's decimal bytes and decoded back."""
    p = star.products(spark, sf_dir)
    enc = p.select("product_id", "price", wire.decimal_to_wire("price", 2).alias("wire_price"))
    return enc.select("product_id", F.col("price").cast("double").alias("price"), "wire_price",
                      wire.wire_to_decimal("wire_price", 10, 2).cast("double").alias("decoded_price"))


@register("epoch_days_calendar", with_star("calendar") + """
SELECT date_code, CAST(full_date - DATE '1970-01-01' AS INTEGER) AS epoch_days,
       CAST(full_date AS VARCHAR) AS decoded_date
FROM calendar""")
def epoch_days_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    cal = star.calendar(spark, sf_dir).select("date_code", wire.date_to_days("full_date").alias("epoch_days"))
    return cal.select("date_code", "epoch_days", wire.days_to_date("epoch_days").cast("string").alias("decoded_date"))


# --------------------------------------------------------------------------
# Standardization


@register("standardized_customers", with_star("customers") + """
SELECT customer_id,
       CASE WHEN length(regexp_replace(phone, '[^0-9+]', '', 'g')) > 0
            THEN regexp_replace(phone, '[^0-9+]', '', 'g') END AS phone,
       upper(trim(country_code)) AS country_code, trim(country) AS country, trim(state) AS state,
       trim(city) AS city
FROM customers""")
def standardized_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = S.trim_strings(star.customers(spark, sf_dir))
    return c.withColumns({"phone": S.normalize_phone("phone"),
                          "country_code": S.normalize_country_code("country_code")})


@register("standardized_products", with_star("products") + """
SELECT product_id, trim(product_name) AS product_name,
       CASE WHEN category_code IS NULL THEN NULL ELSE
         regexp_extract(category_code, '^(.*-)?[^-]*$', 1) ||
         CASE regexp_extract(category_code, '([^-]*)$', 1)
           WHEN 'BOOKS' THEN 'BKS' WHEN 'GROCERY' THEN 'GRCY' WHEN 'TOYS' THEN 'TOY'
           ELSE regexp_extract(category_code, '([^-]*)$', 1) END END AS category_code,
       trim(brand_code) AS brand_code, CAST(price AS DOUBLE) AS price
FROM products""")
def standardized_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = S.trim_strings(star.products(spark, sf_dir))
    return p.select("product_id", "product_name", S.remap_code_suffix("category_code").alias("category_code"),
                    "brand_code", F.col("price").cast("double").alias("price"))
