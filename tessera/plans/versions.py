"""Plans over tables with atomic versions: write-back of an upsert and reload
of a day, each with a writer that dies between its files and its commit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import time as TM
from tessera.functions.standardize import fill_zero
from tessera.plans import register
from tessera.plans.analytics import _money_out
from tessera.plans.ingest import NEXT_RUN_DATE, RUN_DATE
from tessera.plans.oracle_star import with_star
from tessera.plans.quality import UPSERT_SPLIT_MS
from tessera.quality import quarantine as Q
from tessera.quality import registry as R
from tessera.quality.contracts import STAR_CONTRACTS, ColumnSpec, Contract
from tessera.quality.metrics import SKETCH_BITS, daily_sketches, merged_distinct
from tessera.quality.validation import FAILED, UNCASTABLE, flag_rules, landed_columns, landed_violations, quarantine_split
from tessera.session import scratch_path
from tessera.sinks import bronze as B
from tessera.sinks import files
from tessera.sinks import versioned as V
from tessera.sources import star
from tessera.sources.files import read_decimal_comma_csv

# The fact without its customer, in a total order of versions.
LINE_ORDER = star.fact_sort_keys()
_WRITTEN_COLS = ["order_item_id", "order_id", "product_id", "quantity", "total_price", "return_flag", "dt_update"]


def _latest_sql(state: str, where: str) -> str:
    return (f"SELECT '{state}' AS state, order_item_id, order_id, product_id, CAST(quantity AS DOUBLE) AS quantity, "
            "CAST(total_price AS DOUBLE) AS total_price, return_flag, dt_update FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id "
            f"ORDER BY {', '.join(c + ' DESC' for c in LINE_ORDER)}) AS rn FROM order_lines WHERE {where}) t WHERE rn = 1")


@register("upsert_written_back", with_star("order_lines") + "\nUNION ALL\n".join([
    _latest_sql("crashed", f"dt_update <= {UPSERT_SPLIT_MS}"), _latest_sql("committed", "true")]))
def upsert_written_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as a table that is upserted in place: a first batch, a second
    one that dies once its files are written (the table reads as before),
    then the second one again, committed."""
    lines = star.order_lines(spark, sf_dir)
    root, keys = scratch_path(spark, "written-back"), ["order_item_id"]
    first, second = lines.where(F.col("dt_update") <= UPSERT_SPLIT_MS), lines.where(F.col("dt_update") > UPSERT_SPLIT_MS)
    V.upsert(first, root, keys, LINE_ORDER, mark=("lines", 1))
    V.stage_upsert(second, root, keys, LINE_ORDER)
    before = V.live(V.read(spark, root))
    V.upsert(second, root, keys, LINE_ORDER, mark=("lines", 2))
    after = V.live(V.read(spark, root))
    out = before.select(F.lit("crashed").alias("state"), "*").unionByName(after.select(F.lit("committed").alias("state"), "*"))
    return _money_out(out).select("state", *_WRITTEN_COLS)


_HALF = f"dt_update <= {UPSERT_SPLIT_MS}"


@register("bronze_atomic_reload", with_star("order_lines") + "\nUNION ALL\n".join(
    f"SELECT '{state}' AS state, '{day}' AS processing_date, COUNT(*) AS rows, CAST(SUM(quantity) AS DOUBLE) AS units FROM order_lines WHERE {where}"
    for state, day, where in (("loaded", RUN_DATE, "true"), ("loaded", NEXT_RUN_DATE, "true"),
                              ("crashed", RUN_DATE, "true"), ("crashed", NEXT_RUN_DATE, "true"),
                              ("reloaded", RUN_DATE, _HALF), ("reloaded", NEXT_RUN_DATE, "true"),
                              ("emptied", NEXT_RUN_DATE, "true"))))
def bronze_atomic_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days of the fact in bronze; the first is reloaded with fewer rows by
    a writer that dies before its commit, then by one that doesn't, then from
    an empty input.  Every state is read from its own version."""
    lines, root = star.order_lines(spark, sf_dir), scratch_path(spark, "bronze-versions")
    states = []

    def now(state: str) -> None:
        states.append((state, V.load(spark, root)))
    for day in (RUN_DATE, NEXT_RUN_DATE):
        V.reload_slices(B.with_bronze_metadata(lines, day), root, B.PROCESSING_DATE, [day], slices=1)
    now("loaded")
    fewer = B.with_bronze_metadata(lines.where(_HALF), RUN_DATE)
    V.stage(fewer, root, F.col(B.PROCESSING_DATE).cast("string"), slices=1)
    now("crashed")
    V.reload_slices(fewer, root, B.PROCESSING_DATE, [RUN_DATE], slices=1)
    now("reloaded")
    V.reload_slices(B.with_bronze_metadata(lines.limit(0), RUN_DATE), root, B.PROCESSING_DATE, [RUN_DATE], slices=1)
    now("emptied")
    return reduce(DataFrame.unionByName, [
        V.read(spark, root, version).groupBy(F.lit(state).alias("state"), F.col(B.PROCESSING_DATE).cast("string").alias("processing_date"))
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("quantity").cast("double").alias("units")) for state, version in states])


# Rows whose customer isn't active wait in quarantine until the parent table
# holds all customers.
_REPLAY_RULES = STAR_CONTRACTS["order_items"]


@register("quarantine_replay", with_star("order_items") + """
, f AS (SELECT t.*, EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = t.customer_id AND c.c_acctbal > 0) AS active,
               COUNT(*) OVER (PARTITION BY order_item_id) > 1 AS dup,
               quantity > 0 AND total_price >= 0 AND discount BETWEEN 0 AND 1 AND return_flag IN ('A', 'N', 'R') AND line_status IN ('O', 'F') AS sound
        FROM order_items t)
SELECT 'stored' AS state, COUNT(*) AS input_rows, CAST(SUM(CASE WHEN active AND NOT dup AND sound THEN 1 ELSE 0 END) AS BIGINT) AS passed_rows,
       CAST(SUM(CASE WHEN active AND NOT dup AND sound THEN 0 ELSE 1 END) AS BIGINT) AS quarantined_rows FROM f
UNION ALL
SELECT 'replayed', COUNT(*), CAST(SUM(CASE WHEN NOT dup AND sound THEN 1 ELSE 0 END) AS BIGINT),
       CAST(SUM(CASE WHEN NOT dup AND sound THEN 0 ELSE 1 END) AS BIGINT) FROM f""")
def quarantine_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact judged while only active customers are known, stored with its
    quarantine, and replayed once all customers are there: rows that waited
    for their parent move over, repeated keys stay, and each version holds
    every row once."""
    items, root = star.order_items(spark, sf_dir), scratch_path(spark, "quarantine")
    parents = {"products": star.products(spark, sf_dir), "calendar": star.calendar_keys(spark, sf_dir)}
    customers = star.read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"), "c_acctbal")
    states = [("stored", Q.store(items, root, _REPLAY_RULES, parents | {"customers": customers.where("c_acctbal > 0")}, "first", "active customers"))]
    states.append(("replayed", Q.replay(spark, root, _REPLAY_RULES, parents | {"customers": customers}, "all customers")))
    return reduce(DataFrame.unionByName, [
        Q.counts(spark, root, version).select(F.lit(state).alias("state"), (F.col("passed_rows") + F.col("quarantined_rows")).alias("input_rows"),
                                              "passed_rows", "quarantined_rows") for state, version in states])


_LANDED = Contract("events", 1, (ColumnSpec("event_id", "bigint", False), ColumnSpec("ts", "timestamp", False), ColumnSpec("user_id", "string", False),
                                 ColumnSpec("event_type", "string", False), ColumnSpec("amount", "decimal(10,2)"), ColumnSpec("props", "string", False)),
                   ("event_id",))


@register("landed_schema_violations", """
WITH e AS (SELECT *, CASE WHEN event_type <> 'error' THEN props END AS landed_props FROM events)
SELECT 'events' AS table_name, column_name, violation, expected_type, rows FROM (
  SELECT 'user_id' AS column_name, 'type_mismatch' AS violation, 'string' AS expected_type, COUNT(user_id) AS rows FROM e HAVING COUNT(user_id) > 0
  UNION ALL SELECT 'amount', 'missing', 'decimal(10,2)', 0
  UNION ALL SELECT 'value', 'extra', NULL, COUNT(value) FROM e HAVING COUNT(value) > 0
  UNION ALL SELECT 'props', 'incomplete', 'string', COUNT(landed_props) FROM e HAVING COUNT(landed_props) BETWEEN 1 AND COUNT(*) - 1) v""")
def landed_schema_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as JSON (``props`` left out of errors) against a contract
    that wants text user ids, an amount and ``props`` everywhere: what differs
    is found in the landed lines."""
    landing = scratch_path(spark, "landed")
    events = star.read_table(spark, sf_dir, "events")
    events.withColumn("props", F.when(F.col("event_type") != "error", F.col("props"))).write.json(landing)
    return landed_violations(spark.read.text(landing), _LANDED).drop("found_type")


@register("distinct_users_by_sketch", """
SELECT 'day' AS period, CAST(CAST(ts AS DATE) AS VARCHAR) AS starts, COUNT(*) AS rows, COUNT(DISTINCT user_id) AS distinct_users, true AS within_error
FROM events GROUP BY 1, 2
UNION ALL
SELECT 'week', CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR), COUNT(*), COUNT(DISTINCT user_id), true FROM events GROUP BY 1, 2
UNION ALL
SELECT 'all', NULL, COUNT(*), COUNT(DISTINCT user_id), true FROM events""")
def distinct_users_by_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users per day, week and over all: sketches made once per day and
    written, weeks and the whole merged from them, each held against the
    exact count (within four standard errors)."""
    events, day = star.read_table(spark, sf_dir, "events"), F.to_date("ts")
    path = scratch_path(spark, "sketches")
    daily_sketches(events, day, "user_id").write.parquet(path)
    sketches = spark.read.schema("day date, sketch binary, rows long").parquet(path)
    week = lambda d: F.trunc(d, "week").cast("string")
    periods = (("day", F.col("day").cast("string"), day.cast("string")), ("week", week("day"), week("ts")), ("all", F.lit("whole"), F.lit("whole")))
    merged = reduce(DataFrame.unionByName, [merged_distinct(sketches, F.lit(p).alias("period"), k.alias("key")) for p, k, _ in periods])
    exact = reduce(DataFrame.unionByName, [events.groupBy(F.lit(p).alias("period"), k.alias("key")).agg(F.countDistinct("user_id").alias("distinct_users"))
                                           for p, _, k in periods])
    off = F.abs(F.col("distinct_values") - F.col("distinct_users"))
    error = 4 * 0.83 / 2 ** (SKETCH_BITS / 2)
    return merged.join(exact, ["period", "key"]).select(
        "period", F.when(F.col("period") != "all", F.col("key")).alias("starts"), "rows", "distinct_users",
        (off <= F.greatest(F.lit(1.0), error * F.col("distinct_users"))).alias("within_error"))


# The events' last days are kept as streamed hours, snapshots for a week.
_TODAY, _STREAM_DAYS = "2024-02-01", 20
_SNAPSHOTS = ["2024-01-20", "2024-01-25", "2024-01-31"]


@register("retention_by_age", f"""
SELECT 'streamed' AS kind, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, COUNT(*) AS rows FROM events
WHERE date_diff('day', CAST(ts AS DATE), DATE '{_TODAY}') <= {_STREAM_DAYS} GROUP BY 1, 2
UNION ALL
SELECT 'snapshot', s, (SELECT COUNT(*) FROM events) FROM (VALUES {", ".join(f"('{s}')" for s in _SNAPSHOTS)}) v(s)
WHERE date_diff('day', CAST(s AS DATE), DATE '{_TODAY}') <= 7""")
def retention_by_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of streamed events and full snapshots below one landing; what is
    older on a given day than its kind may be is found by a listing and
    deleted, the rest read back."""
    root, events = scratch_path(spark, "retention"), star.read_table(spark, sf_dir, "events")
    files.write_hour_partitioned(events, f"{root}/events/streamed", "ts", 1000)
    for stamp in _SNAPSHOTS:
        files.write_snapshot(events, f"{root}/snapshots", "brz_events", stamp)
    files.retain(spark, root, _TODAY, stream_days=_STREAM_DAYS)
    streamed = spark.read.schema("event_id long, year string, month string, day string, hour string").json(f"{root}/events/streamed")
    kept = spark.read.schema("event_id long, snapshot_ts string").json(f"{root}/snapshots/events")
    return (streamed.groupBy(F.lit("streamed").alias("kind"), F.concat_ws("-", "year", "month", "day").alias("day")).agg(F.count(F.lit(1)).alias("rows"))
            .unionByName(kept.groupBy(F.lit("snapshot").alias("kind"), F.col("snapshot_ts").alias("day")).agg(F.count(F.lit(1)).alias("rows"))))


_RUN = ["customers", "lost_table", "order_items", "products"]


@register("bronze_concurrent_run", with_star("customers", "order_items", "products") + """
SELECT 'customers' AS "table", 'SUCCESS' AS status, COUNT(*) AS rows FROM customers
UNION ALL SELECT 'order_items', 'SUCCESS', COUNT(*) FROM order_items
UNION ALL SELECT 'products', 'SUCCESS', COUNT(*) FROM products
UNION ALL SELECT 'lost_table', 'FAILED', NULL""")
def bronze_concurrent_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze loads of several tables at once, each an atomic day reload; a
    table that isn't there fails without stopping the others."""
    root = scratch_path(spark, "concurrent")

    def load(table: str) -> int:
        rows = star.read_table(spark, sf_dir, table) if table not in star.STAR_TABLES else star.star_table(spark, sf_dir, table)
        target = f"{root}/{table}"
        V.reload_slices(B.with_bronze_metadata(rows, RUN_DATE), target, B.PROCESSING_DATE, [RUN_DATE])
        return V.read(spark, target).count()
    return B.run_tables(spark, _RUN, load, at_once=3).drop("error")


# Every seventh order writes its price with a unit behind it, every eleventh
# its date month first: neither can be parsed.
_CSV = ["Id", "Tipo", "Vencimento", "Preco"]
_PRICES = Contract("prices", 1, (ColumnSpec("Id", "string", False), ColumnSpec("Tipo", "string"), ColumnSpec("Vencimento", "date"),
                                 ColumnSpec("Preco", "decimal(12,2)")), ("Id",))


@register("csv_lost_values", """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
       concat_ws(',', CASE WHEN l_orderkey % 7 = 0 THEN 'cast:Preco' END,
                      CASE WHEN l_orderkey % 11 = 0 AND day(l_shipdate) > 12 THEN 'cast:Vencimento' END) AS failed_rules,
       concat_ws(',', CASE WHEN l_orderkey % 7 = 0 THEN replace(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR), '.', ',') || ' BRL' END,
                      CASE WHEN l_orderkey % 11 = 0 AND day(l_shipdate) > 12 THEN strftime(l_shipdate, '%m/%d/%Y') END) AS raw
FROM lineitem WHERE l_orderkey % 7 = 0 OR (l_orderkey % 11 = 0 AND day(l_shipdate) > 12)""")
def csv_lost_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices and dates of a decimal-comma CSV that can't be parsed: their rows
    are quarantined with the text that was there."""
    root, li = scratch_path(spark, "csv-lost"), star.read_table(spark, sf_dir, "lineitem")
    price = F.regexp_replace(F.col("l_extendedprice").cast("decimal(12,2)").cast("string"), r"\.", ",")
    li.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("Id"), F.col("l_returnflag").alias("Tipo"),
              F.when(F.col("l_orderkey") % 11 == 0, F.date_format("l_shipdate", "MM/dd/yyyy")).otherwise(F.date_format("l_shipdate", "dd/MM/yyyy")).alias("Vencimento"),
              F.when(F.col("l_orderkey") % 7 == 0, F.concat(price, F.lit(" BRL"))).otherwise(price).alias("Preco")) \
        .write.option("header", "true").option("sep", ";").csv(root)
    rows = read_decimal_comma_csv(spark, root, _CSV, {"Preco": "decimal(12,2)"}, ["Vencimento"], keep=True)
    _, held = quarantine_split(flag_rules(rows, _PRICES, check_duplicates=False))
    raw = F.transform(F.array_sort(UNCASTABLE), lambda x: x["raw"])
    return held.select(F.col("Id").alias("id"), F.array_join(FAILED, ",").alias("failed_rules"), F.array_join(raw, ",").alias("raw"))


# Two bond types by the names that the source gives them; the base price is
# missing where nothing was discounted.
_TYPES = {"PRE-FIXADOS": "A", "IPCA": "N"}
_BOND_SQL = "\nUNION ALL\n".join(
    f"SELECT DISTINCT '{name}' AS Tipo, strftime(l_shipdate, '%Y-%m-%d') AS Data_Vencimento, strftime(l_shipdate - to_days(CAST(l_linenumber AS INTEGER)), '%Y-%m-%d') AS Data_Base, "
    "CAST(l_extendedprice AS DECIMAL(12,2)) AS pc, CASE WHEN l_discount > 0 THEN CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) "
    f"ELSE 0 END AS pb FROM lineitem WHERE l_returnflag = '{flag}'" for name, flag in _TYPES.items())


@register("bond_base_prices", f"""
SELECT Tipo, min(Data_Base) AS first_base, max(Data_Vencimento) AS last_due, CAST(SUM(pc) AS DOUBLE) / COUNT(*) AS Media_PUCompraManha,
       CAST(SUM(pb) AS DOUBLE) / COUNT(*) AS Media_PUBaseManha, COUNT(*) AS Total_Registros
FROM ({_BOND_SQL}) b GROUP BY Tipo""")
def bond_base_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bonds picked by type, each type under a constant label of its own, with
    base date and base price: silver turns both dates to text and missing
    base prices to zero, gold averages per label."""
    li = star.read_table(spark, sf_dir, "lineitem")
    money = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    bronze = reduce(DataFrame.unionByName, [
        li.where(F.col("l_returnflag") == flag).select(
            F.lit(name).alias("Tipo"), TM.ntz_millis("l_shipdate").alias("Data_Vencimento"), (TM.ntz_millis("l_shipdate") - F.col("l_linenumber") * 86_400_000).alias("Data_Base"),
            money.alias("PUCompraManha"), F.when(discount > 0, money * discount).alias("PUBaseManha")) for name, flag in _TYPES.items()])
    silver = bronze.dropDuplicates().withColumns({c: TM.millis_to_date_text(c) for c in ("Data_Vencimento", "Data_Base")})
    silver = fill_zero(silver, ["PUCompraManha", "PUBaseManha"])
    path = scratch_path(spark, "bond-base")
    files.write_layer(silver, path)
    mean = lambda c: F.sum(c).cast("double") / F.count(F.lit(1))
    return spark.read.schema(silver.schema).parquet(path).groupBy("Tipo").agg(
        F.min("Data_Base").alias("first_base"), F.max("Data_Vencimento").alias("last_due"), mean("PUCompraManha").alias("Media_PUCompraManha"),
        mean("PUBaseManha").alias("Media_PUBaseManha"), F.count(F.lit(1)).alias("Total_Registros"))


_BRAND_SEED, _BRANDS = "spring", 40


@register("brand_seeded_pick", with_star("brands", "category") + f"""
, c AS (SELECT category_code AS dealt_category, row_number() OVER (ORDER BY category_code) - 1 AS k, COUNT(*) OVER () AS many FROM category),
n AS (SELECT DISTINCT brand_code FROM brands),
b AS (SELECT brand_code, row_number() OVER (ORDER BY md5('{_BRAND_SEED}' || brand_code), brand_code) - 1 AS place FROM n
      QUALIFY place < {_BRANDS})
SELECT place, brand_code, dealt_category FROM b JOIN c ON place % many = k""")
def brand_seeded_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first brands in an order shuffled by a seed (a top-k by digest, no
    sort of all), dealt to the categories in turn."""
    codes = star.brands(spark, sf_dir).select("brand_code").distinct()
    shuffled = codes.withColumn("order", F.md5(F.concat(F.lit(_BRAND_SEED), "brand_code").cast("binary")))
    first = shuffled.orderBy("order", "brand_code").limit(_BRANDS)
    place = F.row_number().over(Window.orderBy("order", "brand_code")) - 1  # of the few picked
    categories = star.category(spark, sf_dir).select("category_code").distinct()
    dealt = categories.agg(F.sort_array(F.collect_list("category_code")).alias("all"))
    picked = first.withColumn("place", place.cast("bigint")).withColumn("all", dealt.scalar())
    return picked.select("place", "brand_code", F.get("all", F.col("place") % F.size("all")).alias("dealt_category"))


# Three landings of the events, as a feed that grows: the second adds a column
# and leaves another out in places, the third turns a number into text.
_FEEDS = [["event_id", "user_id", "props"], ["event_id", "user_id", "some_props AS props", "value"],
          ["event_id", "CAST(user_id AS STRING) AS user_id", "some_props AS props", "value"]]


@register("contract_changes", """
WITH e AS (SELECT *, CASE WHEN event_type <> 'error' THEN props END AS some_props FROM events),
n AS (SELECT COUNT(*) AS rows, COUNT(some_props) AS given, COUNT(props) AS props, COUNT(value) AS value FROM e)
SELECT 'events' AS table_name, from_version, from_version + 1 AS to_version, column_name, change, kind FROM (
  SELECT 1 AS from_version, 'value' AS column_name, 'added' AS change, CASE WHEN value = rows THEN 'breaking' ELSE 'additive' END AS kind FROM n WHERE value > 0
  UNION ALL SELECT 1, 'props', 'nullable', 'additive' FROM n WHERE props = rows AND given BETWEEN 1 AND rows - 1
  UNION ALL SELECT 2, 'user_id', 'type bigint -> string', 'breaking' FROM n WHERE rows > 0) v""")
def contract_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each landing's columns, found in its lines, registered as a version of
    the feed's contract; every version against the one before it."""
    events = star.read_table(spark, sf_dir, "events").withColumn("some_props", F.when(F.col("event_type") != "error", F.col("props")))
    root = scratch_path(spark, "contracts")
    for k, columns in enumerate(_FEEDS):
        landing = scratch_path(spark, f"feed-{k}")
        events.selectExpr(*columns).write.json(landing)
        lines = spark.read.text(landing)
        R.register(spark, root, "events", R.columns_found(landed_columns(lines), lines.count(), ["event_id"]))
    return R.changes(V.read(spark, root))
