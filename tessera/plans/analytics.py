"""Star-schema analytics: revenue rankings, country sales, row counts,
key and FK validation, dedup, calendar, event slices and sessions.

Money is summed as DECIMAL (exact, so any partial-aggregation order gives
the same total) and cast to DOUBLE only in the output.  Fact tables are
pre-aggregated on the join key before meeting a dimension, so the join sees
one row per key instead of one row per fact line.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import time as T
from tessera.operators.dedup import duplicate_stats, latest_per_key
from tessera.operators.dimensions import calendar_parts
from tessera.operators.joins import attach, orphan_counts
from tessera.operators.sessions import sessions_by_gap
from tessera.plans import register
from tessera.plans.oracle_star import with_star
from tessera.session import guarded_broadcast
from tessera.sources import star
from tessera.sources.star import read_table

# --------------------------------------------------------------------------
# Revenue rankings (fact -> product)


def product_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue and units per product name, all products."""
    lines = star.order_lines(spark, sf_dir)
    per_product = lines.groupBy("product_id").agg(
        F.sum("quantity").alias("_qty"), F.sum("total_price").alias("_rev"))
    names = star.products(spark, sf_dir).select("product_id", "product_name")
    joined = per_product.join(guarded_broadcast(names), "product_id")
    return joined.groupBy("product_name").agg(
        F.sum("_qty").cast("double").alias("total_sold"),
        F.sum("_rev").cast("double").alias("revenue"))


@register("top_products_revenue", with_star("order_lines", "products") + """
SELECT p.product_name, CAST(SUM(oi.quantity) AS DOUBLE) AS total_sold,
       CAST(SUM(oi.total_price) AS DOUBLE) AS revenue
FROM order_lines oi JOIN products p ON oi.product_id = p.product_id
GROUP BY p.product_name
ORDER BY revenue DESC, p.product_name
LIMIT 10""")
def top_products_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_revenue(spark, sf_dir).orderBy(F.desc("revenue"), F.asc("product_name")).limit(10)


@register("revenue_by_product", with_star("order_lines", "products") + """
SELECT p.product_name, CAST(SUM(oi.quantity) AS DOUBLE) AS total_sold,
       CAST(SUM(oi.total_price) AS DOUBLE) AS revenue
FROM order_lines oi JOIN products p ON oi.product_id = p.product_id
GROUP BY p.product_name
ORDER BY revenue DESC, p.product_name""")
def revenue_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_revenue(spark, sf_dir).orderBy(F.desc("revenue"), F.asc("product_name"))


# --------------------------------------------------------------------------
# Sales by country (fact -> order -> customer -> nation)


def _order_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line group: (order_id, customer_id, country, rev).

    Lines are summed per order before the join with orders, so the large
    join carries one row per order."""
    per_order = star.order_lines(spark, sf_dir).groupBy("order_id").agg(
        F.sum("total_price").alias("_rev"))
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"))
    custs = star.customers(spark, sf_dir).select("customer_id", "country")
    return per_order.join(orders, "order_id").join(guarded_broadcast(custs), "customer_id")


@register("sales_by_country", with_star("order_items", "customers") + """
SELECT c.country, COUNT(DISTINCT oi.order_id) AS orders,
       CAST(SUM(oi.total_price) AS DOUBLE) AS revenue
FROM order_items oi JOIN customers c ON oi.customer_id = c.customer_id
GROUP BY c.country
ORDER BY revenue DESC, c.country""")
def sales_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    oc = _order_country(spark, sf_dir)
    return (oc.groupBy("country")
            .agg(F.countDistinct("order_id").alias("orders"), F.sum("_rev").cast("double").alias("revenue"))
            .orderBy(F.desc("revenue"), F.asc("country")))


@register("country_customers_orders", with_star("order_items", "customers") + """
SELECT c.country, COUNT(DISTINCT oi.customer_id) AS customers,
       COUNT(DISTINCT oi.order_id) AS orders,
       CAST(SUM(oi.total_price) AS DOUBLE) AS revenue
FROM order_items oi JOIN customers c ON oi.customer_id = c.customer_id
GROUP BY c.country
ORDER BY revenue DESC, c.country""")
def country_customers_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one row per order, so counting rows per customer counts orders: two
    # plain aggregations instead of expanding the rows for two distinct counts
    per_customer = _order_country(spark, sf_dir).groupBy("customer_id", "country").agg(
        F.count(F.lit(1)).alias("_orders"), F.sum("_rev").alias("_rev"))
    return (per_customer.groupBy("country")
            .agg(F.count(F.lit(1)).alias("customers"), F.sum("_orders").cast("bigint").alias("orders"),
                 F.sum("_rev").cast("double").alias("revenue"))
            .orderBy(F.desc("revenue"), F.asc("country")))


# --------------------------------------------------------------------------
# Full star (fact with every dimension)


def denormalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    prods = star.products(spark, sf_dir).select("product_id", "product_name", "brand_code", "category_code")
    brands = star.brands(spark, sf_dir).select("brand_code", "brand_name")
    cats = star.category(spark, sf_dir)
    custs = star.customers(spark, sf_dir).select("customer_id", "country", "state", "city")
    # dimensions first meet each other and the orders, so that the fact is joined once per key
    items = star.order_items(spark, sf_dir, custs)
    prods = attach(attach(prods, brands, "brand_code", "inner"), cats, "category_code", "inner")
    # year to weekend flag are functions of the date: no join with the calendar
    parts = calendar_parts(star.day_of("date_code"))
    out = attach(items.where("date_code is not null"), prods, "product_id", "inner")
    return out.withColumns({n: parts[n] for n in ("year", "quarter", "month", "day_name", "is_weekend")})


STAR_COLUMNS = ["order_item_id", "order_id", "customer_id", "product_id", "date_code", "quantity",
                "total_price", "dt_update", "product_name", "brand_name", "category_name",
                "country", "state", "city", "year", "quarter", "month", "day_name", "is_weekend"]


@register("star_denormalized", with_star("order_items", "products", "brands", "category",
                                         "customers", "calendar") + """
SELECT oi.order_item_id, oi.order_id, oi.customer_id, oi.product_id, oi.date_code, CAST(oi.quantity AS DOUBLE) AS quantity,
       CAST(oi.total_price AS DOUBLE) AS total_price, oi.dt_update, p.product_name, b.brand_name,
       cat.category_name, c.country, c.state, c.city, cal.year, cal.quarter, cal.month,
       cal.day_name, cal.is_weekend
FROM order_items oi
JOIN products p ON oi.product_id = p.product_id
JOIN brands b ON p.brand_code = b.brand_code
JOIN category cat ON p.category_code = cat.category_code
JOIN customers c ON oi.customer_id = c.customer_id
JOIN calendar cal ON oi.date_code = cal.date_code""")
def star_denormalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money_out(denormalized(spark, sf_dir)).select(*STAR_COLUMNS)


@register("revenue_by_category_quarter", with_star("order_lines", "products", "category", "calendar") + """
SELECT cat.category_name, cal.year, cal.quarter, COUNT(*) AS items,
       CAST(SUM(oi.quantity) AS DOUBLE) AS units, CAST(SUM(oi.total_price) AS DOUBLE) AS revenue
FROM order_lines oi
JOIN products p ON oi.product_id = p.product_id
JOIN category cat ON p.category_code = cat.category_code
JOIN calendar cal ON oi.date_code = cal.date_code
GROUP BY cat.category_name, cal.year, cal.quarter
ORDER BY cat.category_name, cal.year, cal.quarter""")
def revenue_by_category_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Pre-aggregate the fact on (product, day) first: the join inputs then
    # scale with products x days, not with fact lines.
    lines = star.order_lines(spark, sf_dir).groupBy("product_id", "date_code").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("quantity").alias("_q"), F.sum("total_price").alias("_r"))
    prods = star.products(spark, sf_dir).select("product_id", "category_code")
    cats = star.category(spark, sf_dir)
    parts = calendar_parts(star.day_of("date_code"))
    lines = lines.where("date_code is not null").withColumns({n: parts[n] for n in ("year", "quarter")})
    j = attach(attach(lines, prods, "product_id", "inner"), cats, "category_code", "inner")
    return (j.groupBy("category_name", "year", "quarter")
            .agg(F.sum("_n").cast("bigint").alias("items"), F.sum("_q").cast("double").alias("units"),
                 F.sum("_r").cast("double").alias("revenue"))
            .orderBy("category_name", "year", "quarter"))


# --------------------------------------------------------------------------
# Row counts, key validation and FK integrity over the six star tables

TABLE_ORDER = ["brands", "calendar", "category", "customers", "order_items", "products"]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@register("table_row_counts", with_star(*TABLE_ORDER) + """
SELECT table_name, row_count, CASE WHEN row_count > 0 THEN 'OK' ELSE 'EMPTY' END AS status
FROM (
  SELECT 'brands' AS table_name, COUNT(*) AS row_count FROM brands
  UNION ALL SELECT 'calendar', COUNT(*) FROM calendar
  UNION ALL SELECT 'category', COUNT(*) FROM category
  UNION ALL SELECT 'customers', COUNT(*) FROM customers
  UNION ALL SELECT 'order_items', COUNT(*) FROM order_items
  UNION ALL SELECT 'products', COUNT(*) FROM products
) t
ORDER BY table_name""")
def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.quality.metrics import row_counts
    return row_counts({n: star.star_table(spark, sf_dir, n) for n in TABLE_ORDER})


@register("validate_row_id", with_star(*TABLE_ORDER) + """
SELECT table_name, total_rows, unique_rows, total_rows - unique_rows AS duplicate_rows
FROM (
  SELECT 'brands' AS table_name, COUNT(*) AS total_rows, COUNT(DISTINCT uuid()) AS unique_rows FROM brands
  UNION ALL SELECT 'calendar', COUNT(*), COUNT(DISTINCT uuid()) FROM calendar
  UNION ALL SELECT 'category', COUNT(*), COUNT(DISTINCT uuid()) FROM category
  UNION ALL SELECT 'customers', COUNT(*), COUNT(DISTINCT uuid()) FROM customers
  UNION ALL SELECT 'order_items', COUNT(*), COUNT(DISTINCT uuid()) FROM order_items
  UNION ALL SELECT 'products', COUNT(*), COUNT(DISTINCT uuid()) FROM products
) t
ORDER BY table_name""")
def validate_row_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze check on the per-row uuid: always 0 duplicates, since
    every row gets a fresh id.  Kept for parity; see validate_business_key."""
    from tessera.sinks.bronze import with_bronze_metadata
    frames = []
    for name in TABLE_ORDER:
        b = with_bronze_metadata(star.star_table(spark, sf_dir, name), "1970-01-01")
        frames.append(b.agg(F.count(F.lit(1)).alias("total_rows"),
                            F.countDistinct("_row_id").alias("unique_rows"))
                      .select(F.lit(name).alias("table_name"), "total_rows", "unique_rows",
                              (F.col("total_rows") - F.col("unique_rows")).alias("duplicate_rows")))
    return _union(frames).orderBy("table_name")


@register("validate_business_key", with_star(*TABLE_ORDER) + """
SELECT table_name, total_rows, unique_keys, total_rows - unique_keys AS duplicate_rows
FROM (
  SELECT 'brands' AS table_name, COUNT(*) AS total_rows, COUNT(DISTINCT brand_code) AS unique_keys FROM brands
  UNION ALL SELECT 'calendar', COUNT(*), COUNT(DISTINCT date_code) FROM calendar
  UNION ALL SELECT 'category', COUNT(*), COUNT(DISTINCT category_code) FROM category
  UNION ALL SELECT 'customers', COUNT(*), COUNT(DISTINCT customer_id) FROM customers
  UNION ALL SELECT 'order_items', COUNT(*), COUNT(DISTINCT order_item_id) FROM order_items
  UNION ALL SELECT 'products', COUNT(*), COUNT(DISTINCT product_id) FROM products
) t
ORDER BY table_name""")
def validate_business_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = [duplicate_stats(star.star_table(spark, sf_dir, n), star.primary_key(n))
              .select(F.lit(n).alias("table_name"), "*") for n in TABLE_ORDER]
    return _union(frames).orderBy("table_name")


FK_EDGES = [
    ("brands", "category_code", "category", "category_code"),
    ("products", "brand_code", "brands", "brand_code"),
    ("products", "category_code", "category", "category_code"),
    ("order_items", "customer_id", "customers", "customer_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "date_code", "calendar", "date_code"),
]


def _orphan_sql() -> str:
    parts = []
    for child, col, parent, pcol in FK_EDGES:
        parts.append(
            f"SELECT '{child}' AS child_table, '{col}' AS fk_column, '{parent}' AS parent_table, "
            f"CAST(SUM(CASE WHEN x.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} y WHERE y.{pcol} = x.{col}) THEN 1 ELSE 0 END) AS BIGINT) AS orphans, "
            f"COUNT(*) AS child_rows FROM {child} x")
    parts.append("SELECT 'order_items', 'customer_id', 'active_customers', CAST(SUM(CASE WHEN NOT EXISTS (SELECT 1 FROM customer y "
                 "WHERE y.c_acctbal > 0 AND y.c_custkey = x.customer_id) THEN 1 ELSE 0 END) AS BIGINT), COUNT(*) FROM order_items x")
    return with_star(*TABLE_ORDER) + "\nUNION ALL\n".join(parts) + "\nORDER BY child_table, fk_column, parent_table"


@register("orphan_counts", _orphan_sql())
def orphan_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {n: star.star_table(spark, sf_dir, n) for n in TABLE_ORDER if n != "calendar"}
    tables["calendar"] = star.calendar_keys(spark, sf_dir)
    edges = [(c, tables[c], col, p, tables[p], pcol) for c, col, p, pcol in FK_EDGES]
    # active customers only (a positive balance) are parents in a second check, which has orphans to find
    active = star.read_table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("customer_id"))
    edges.append(("order_items", tables["order_items"], "customer_id", "active_customers", active, "customer_id"))
    return orphan_counts(edges).orderBy("child_table", "fk_column", "parent_table")


@register("resolved_order_items", with_star("order_items", "customers", "products", "calendar") + """
SELECT order_item_id, order_id, customer_id, product_id, date_code, CAST(quantity AS DOUBLE) AS quantity,
       CAST(total_price AS DOUBLE) AS total_price, dt_update
FROM order_items oi
WHERE EXISTS (SELECT 1 FROM customers c WHERE c.customer_id = oi.customer_id)
  AND EXISTS (SELECT 1 FROM products p WHERE p.product_id = oi.product_id)
  AND EXISTS (SELECT 1 FROM calendar d WHERE d.date_code = oi.date_code)""")
def resolved_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.operators.joins import resolved
    items = star.order_items(spark, sf_dir)
    items = resolved(items, star.customers(spark, sf_dir), "customer_id", "customer_id")
    items = resolved(items, star.products(spark, sf_dir), "product_id", "product_id")
    items = resolved(items, star.calendar_keys(spark, sf_dir), "date_code", "date_code")
    return _money_out(items).select("order_item_id", "order_id", "customer_id", "product_id", "date_code", "quantity",
                                    "total_price", "dt_update")


_DISTINCT_TARGETS = [("countries", "customers", "country"), ("cities", "customers", "city"),
                     ("brand_names", "brands", "brand_name"), ("product_names", "products", "product_name"),
                     ("categories", "category", "category_name")]


@register("distinct_values", with_star("customers", "brands", "products", "category")
          + "\nUNION ALL\n".join(f"SELECT '{m}' AS metric, COUNT(DISTINCT {c}) AS distinct_values FROM {t}"
                                  for m, t, c in _DISTINCT_TARGETS) + "\nORDER BY metric")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct countries, cities, brands, product names and categories, as
    (metric, distinct_values) rows.  Exact here; ``distinct_counts(...,
    approx=True)`` is the HyperLogLog form for very large columns."""
    from tessera.quality.metrics import distinct_counts
    return distinct_counts([(m, star.star_table(spark, sf_dir, t), c) for m, t, c in _DISTINCT_TARGETS]) \
        .orderBy("metric")


# --------------------------------------------------------------------------
# Calendar, dedup, latest rows

@register("calendar_dim", with_star("calendar") + """
SELECT date_code, CAST(full_date AS VARCHAR) AS full_date, year, quarter, month, month_name, day,
       day_of_week, day_name, is_weekend
FROM calendar ORDER BY date_code""")
def calendar_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.calendar(spark, sf_dir).withColumn(
        "full_date", F.col("full_date").cast("string")).orderBy("date_code")


LATEST_COLS = ["order_item_id", "order_id", "customer_id", "product_id", "supplier_id", "date_code",
               "quantity", "total_price", "discount", "tax", "return_flag", "line_status", "dt_update"]


def _money_out(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in ("quantity", "total_price", "discount", "tax")
                           if c in df.columns})


def latest_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(star.order_items(spark, sf_dir), ["order_item_id"], star.fact_sort_keys())


_LATEST_SQL = """
SELECT order_item_id, order_id, customer_id, product_id, supplier_id, date_code, CAST(quantity AS DOUBLE) AS quantity,
       CAST(total_price AS DOUBLE) AS total_price, CAST(discount AS DOUBLE) AS discount,
       CAST(tax AS DOUBLE) AS tax, return_flag, line_status, dt_update
FROM (SELECT *, row_number() OVER (PARTITION BY order_item_id
        ORDER BY dt_update DESC, product_id DESC, supplier_id DESC, quantity DESC, total_price DESC,
                 discount DESC, tax DESC, return_flag DESC, line_status DESC) AS rn
      FROM order_items) t
WHERE rn = 1"""


@register("latest_order_items", with_star("order_items") + _LATEST_SQL)
def latest_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money_out(latest_items(spark, sf_dir)).select(*LATEST_COLS)


@register("latest_10_items", with_star("order_lines") + """
SELECT order_item_id, order_id, product_id, CAST(quantity AS DOUBLE) AS quantity, CAST(total_price AS DOUBLE) AS total_price, dt_update
FROM order_lines
ORDER BY dt_update DESC, order_item_id DESC, product_id DESC, supplier_id DESC, quantity DESC,
         total_price DESC, discount DESC, tax DESC
LIMIT 10""")
def latest_10_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = star.order_lines(spark, sf_dir)
    top = lines.orderBy(*[F.desc(c) for c in ("dt_update", "order_item_id", "product_id", "supplier_id",
                                              "quantity", "total_price", "discount", "tax")]).limit(10)
    return _money_out(top).select("order_item_id", "order_id", "product_id", "quantity", "total_price", "dt_update")


# --------------------------------------------------------------------------
# Events: hour partitions, millisecond ranges, histogram, sessions

EVENT_OUT_SQL = ("event_id, user_id, event_type, value, "
                 "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time")


def _event_out(df: DataFrame, **more) -> DataFrame:
    return df.select("event_id", "user_id", "event_type", "value",
                     F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"),
                     *[c.alias(name) for name, c in more.items()])


def _between(events: DataFrame, low: str, high: str) -> DataFrame:
    """Events of a half-open range of the raw timestamp: both bounds reach the
    parquet scan (row-group skipping)."""
    return events.where((F.col("ts") >= F.lit(low).cast("timestamp_ntz")) & (F.col("ts") < F.lit(high).cast("timestamp_ntz")))


@register("hour_slice", f"""
SELECT {EVENT_OUT_SQL}, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
       strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour
FROM events
WHERE strftime(ts, '%Y') = '2024' AND strftime(ts, '%m') = '01' AND strftime(ts, '%d') = '15'
  AND strftime(ts, '%H') = '07'""")
def hour_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = _between(read_table(spark, sf_dir, "events"), "2024-01-15 07:00:00", "2024-01-15 08:00:00")
    return _event_out(hour, **T.hour_parts("ts"))


@register("day_slice_counts", """
SELECT strftime(ts, '%H') AS hour, event_type, COUNT(*) AS events
FROM events
WHERE strftime(ts, '%Y') = '2024' AND strftime(ts, '%m') = '01' AND strftime(ts, '%d') = '16'
GROUP BY 1, 2 ORDER BY 1, 2""")
def day_slice_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = _between(read_table(spark, sf_dir, "events"), "2024-01-16 00:00:00", "2024-01-17 00:00:00")
    return (day.groupBy(F.date_format("ts", "HH").alias("hour"), "event_type")
            .agg(F.count(F.lit(1)).alias("events")).orderBy("hour", "event_type"))


# 2024-01-10 00:00:00 UTC and one hour, ten minutes later, as epoch millis.
RANGE_LO_MS = 1704844800000
RANGE_HI_MS = 1704849000000


@register("millis_range", f"""
SELECT {EVENT_OUT_SQL}, CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS ts_millis,
       strftime(make_timestamp(CAST(floor(epoch_us(ts) / 1000) AS BIGINT) * 1000), '%Y-%m-%d %H:%M:%S.%f') AS ts_from_millis
FROM events
WHERE floor(epoch_us(ts) / 1000) >= {RANGE_LO_MS} AND floor(epoch_us(ts) / 1000) < {RANGE_HI_MS}""")
def millis_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole milliseconds become bounds of the raw timestamp."""
    low, high = (T.millis_text(ms) for ms in (RANGE_LO_MS, RANGE_HI_MS))
    events = _between(read_table(spark, sf_dir, "events"), low, high).withColumn("ts_millis", T.ntz_millis("ts"))
    back = F.date_format(T.millis_to_ntz("ts_millis"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return _event_out(events, ts_millis=F.col("ts_millis"), ts_from_millis=back)


@register("event_histogram", """
SELECT event_type, COUNT(*) AS events FROM events GROUP BY event_type ORDER BY events DESC, event_type""")
def event_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (read_table(spark, sf_dir, "events").groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("events")).orderBy(F.desc("events"), "event_type"))


SESSION_GAP_SECONDS = 30 * 60


@register("sessions_by_gap", f"""
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
       strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_end, COUNT(*) AS events,
       CAST(floor((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000) AS BIGINT) AS duration_seconds
FROM s GROUP BY user_id, sid""")
def sessions_by_gap_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    s = sessions_by_gap(ev, "user_id", "ts", SESSION_GAP_SECONDS)
    return s.select("user_id",
                    F.date_format("session_start", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("session_start"),
                    F.date_format("session_end", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("session_end"),
                    "events", "duration_seconds")
