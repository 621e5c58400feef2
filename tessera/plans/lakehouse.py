"""Catalog-table bronze loads checked in SQL, snapshot comparison by key
and by row set, and the product enrichment of the catalogue generator."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import dimensions as D
from tessera.operators.dedup import latest_per_key
from tessera.operators.joins import attach, compare_by_key
from tessera.plans import register
from tessera.plans.analytics import TABLE_ORDER
from tessera.plans.oracle_star import with_star
from tessera.plans.quality import UPSERT_SPLIT_MS
from tessera.quality.reconcile import row_set_difference
from tessera.session import scratch_path, sized_shuffles
from tessera.sinks.bronze import with_bronze_metadata
from tessera.sinks.files import GZIP
from tessera.sinks.catalog import load_partitioned_table, register_views
from tessera.sources import star

# --------------------------------------------------------------------------
# Bronze as catalog tables, validated with SQL over the registered names

_KEYS = {t: star.primary_key(t)[0] for t in TABLE_ORDER}


@register("catalog_bronze_validation", with_star(*TABLE_ORDER) + "SELECT table_name, total_rows, unique_keys, "
          "total_rows - unique_keys AS duplicate_rows FROM (\n" + "\nUNION ALL ".join(
              f"SELECT '{t}' AS table_name, COUNT(*) AS total_rows, COUNT(DISTINCT {k}) AS unique_keys FROM {t}"
              for t, k in _KEYS.items()) + "\n) v ORDER BY table_name")
def catalog_bronze_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each star table is registered as a temp view, loaded from it into an
    external catalog table partitioned by processing date (created on the
    first load, the day replaced on the second: the reload is idempotent),
    then the six duplicate checks run as one UNION ALL in Spark SQL over the
    catalog names."""
    root = scratch_path(spark, "catalog")
    tag = root.rsplit("-", 1)[1]
    db = f"tessera_bronze_{tag}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}/_db'")
    with sized_shuffles(spark, star.fact_size(spark, sf_dir)):
        register_views({f"incoming_{t}_{tag}": with_bronze_metadata(star.star_table(spark, sf_dir, t), "1970-01-01")
                        for t in TABLE_ORDER})
        for t in TABLE_ORDER:
            for _ in range(2):  # created, then reloaded
                load_partitioned_table(spark.table(f"incoming_{t}_{tag}"), f"{db}.{t}", f"{root}/{t}")
        selects = [f"SELECT '{t}' AS table_name, COUNT(*) AS total_rows, COUNT(DISTINCT {k}) AS unique_keys "
                   f"FROM {db}.{t}" for t, k in _KEYS.items()]
        report = spark.sql("SELECT table_name, total_rows, unique_keys, total_rows - unique_keys AS duplicate_rows "
                           f"FROM ({' UNION ALL '.join(selects)}) v")
        # The report (one row per table) is written next to the tables.
        report.write.parquet(f"{root}/_report")
    # The scratch database and views are dropped, leaving the catalog as it
    # was (external tables: dropping them keeps their files).
    spark.sql(f"DROP DATABASE {db} CASCADE")
    for t in TABLE_ORDER:
        spark.catalog.dropTempView(f"incoming_{t}_{tag}")
    return spark.read.parquet(f"{root}/_report").orderBy("table_name")


# --------------------------------------------------------------------------
# Two snapshots of the fact table: before the split and now

_VALUE_COLS = ["order_id", "product_id", "supplier_id", "date_code", "quantity", "total_price",
               "discount", "tax", "return_flag", "line_status", "dt_update"]

_LATEST_LINES = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_item_id
      ORDER BY dt_update DESC, product_id DESC, supplier_id DESC, quantity DESC, total_price DESC,
               discount DESC, tax DESC, return_flag DESC, line_status DESC) AS rn
  FROM order_lines {where}) t WHERE rn = 1"""

_SNAPSHOTS_SQL = with_star("order_lines") + f""", b AS ({_LATEST_LINES.format(where=f"WHERE dt_update <= {UPSERT_SPLIT_MS}")}),
a AS ({_LATEST_LINES.format(where="")})
"""


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = star.order_lines(spark, sf_dir)
    keys, order = ["order_item_id"], star.fact_sort_keys()
    before = latest_per_key(lines.where(F.col("dt_update") <= UPSERT_SPLIT_MS), keys, order)
    return before, latest_per_key(lines, keys, order)


@register("snapshot_changes", _SNAPSHOTS_SQL + """
SELECT status, COUNT(*) AS key_count FROM (
  SELECT CASE WHEN a.order_item_id IS NULL THEN 'missing'
              WHEN b.order_item_id IS NULL THEN 'extra'
              WHEN """ + " OR ".join(f"b.{c} IS DISTINCT FROM a.{c}" for c in _VALUE_COLS) + """ THEN 'changed'
              ELSE 'same' END AS status
  FROM b FULL OUTER JOIN a ON a.order_item_id = b.order_item_id) s
GROUP BY status ORDER BY status""")
def snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source (earlier snapshot) against destination (current) by key:
    keys missing, extra, changed or the same."""
    before, after = _snapshots(spark, sf_dir)
    cmp = compare_by_key(before, after, ["order_item_id"], _VALUE_COLS)
    return cmp.groupBy("status").agg(F.count(F.lit(1)).alias("key_count")).orderBy("status")


@register("snapshot_row_diff", _SNAPSHOTS_SQL + """
SELECT (SELECT COUNT(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) x) AS source_only_rows,
       (SELECT COUNT(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) y) AS dest_only_rows""")
def snapshot_row_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows (with multiplicity) only in the earlier or only in the current
    snapshot, counted in one pass over the difference."""
    before, after = _snapshots(spark, sf_dir)
    diff = row_set_difference(before, after)
    return diff.agg(
        F.count(F.when(F.col("side") == "source_only", 1)).alias("source_only_rows"),
        F.count(F.when(F.col("side") == "dest_only", 1)).alias("dest_only_rows"))


# --------------------------------------------------------------------------
# Product enrichment: description, shelf price, brand from the category


def _sql_template(t: str) -> str:
    """One description template as a DuckDB string expression."""
    values = {"Adj": "adj_cap", "adj": "lower(w1)", "Noun": "noun_cap", "noun": "lower(w2)",
              "benefit": "benefit", "a_an": "art", "A_an": "upper(substr(art, 1, 1)) || substr(art, 2)"}
    parts = []
    for piece in re.split(r"(\{[A-Za-z_]+\})", t):
        if piece.startswith("{"):
            parts.append(values[piece[1:-1]])
        elif piece:
            parts.append("'" + piece.replace("'", "''") + "'")
    return " || ".join(parts)


def _sql_pick(templates: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN {_sql_template(t)}" for i, t in enumerate(templates))
    return f"CASE product_id % {len(templates)} {whens} END"


_ENDINGS_SQL = " ".join(f"WHEN {i} THEN {e:.2f}" for i, e in enumerate(D.PRICE_ENDINGS))


@register("product_enrichment", with_star("products", "brands", "category") + f"""
, w AS (
  SELECT p.product_id, p.product_name, p.category_code, p.price,
         split_part(p.product_name, ' ', 1) AS w1, split_part(p.product_name, ' ', 2) AS w2,
         lower(c.category_name) || ' use' AS benefit
  FROM products p LEFT JOIN category c ON c.category_code = p.category_code),
x AS (
  SELECT *, upper(substr(w1, 1, 1)) || lower(substr(w1, 2)) AS adj_cap,
            upper(substr(w2, 1, 1)) || lower(substr(w2, 2)) AS noun_cap,
            CASE WHEN lower(substr(w1, 1, 1)) IN ('a', 'e', 'i', 'o', 'u') THEN 'an' ELSE 'a' END AS art,
            w2 LIKE '%s' AS plural
  FROM w),
cb AS (SELECT category_code, brand_code,
              row_number() OVER (PARTITION BY category_code ORDER BY brand_code) - 1 AS i,
              COUNT(*) OVER (PARTITION BY category_code) AS n
       FROM (SELECT DISTINCT category_code, brand_code FROM brands) d),
ab AS (SELECT brand_code, row_number() OVER (ORDER BY brand_code) - 1 AS i,
              COUNT(*) OVER () AS n FROM (SELECT DISTINCT brand_code FROM brands) d),
cn AS (SELECT DISTINCT category_code, n FROM cb)
SELECT x.product_id, x.product_name, x.category_code,
       CASE WHEN plural THEN {_sql_pick(D.PLURAL_TEMPLATES)} ELSE {_sql_pick(D.SINGULAR_TEMPLATES)} END AS description,
       CAST(CASE WHEN price < 20 THEN round(price, 2)
                 ELSE floor(price) + CASE product_id % {len(D.PRICE_ENDINGS)} {_ENDINGS_SQL} END END AS DOUBLE) AS shelf_price,
       coalesce(s.brand_code, a.brand_code) AS suggested_brand
FROM x LEFT JOIN cn ON cn.category_code = x.category_code
       LEFT JOIN cb s ON s.category_code = x.category_code AND s.i = x.product_id % cn.n
       LEFT JOIN ab a ON a.i = x.product_id % a.n""")
def product_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue text and prices derived per product: a grammatical
    description (article by the adjective, singular or plural template
    picked by the product id), a shelf price with a fixed ending, and a
    suggested brand taken from the product's own category, falling back to
    all brands when the category has none."""
    products = star.products(spark, sf_dir)
    cats = star.category(spark, sf_dir)
    x = attach(products, cats, "category_code").select(
        "product_id", "product_name", "category_code", "price",
        F.split_part("product_name", F.lit(" "), F.lit(1)).alias("w1"),
        F.split_part("product_name", F.lit(" "), F.lit(2)).alias("w2"),
        F.concat(F.lower("category_name"), F.lit(" use")).alias("benefit"))
    described = x.select(
        "product_id", "product_name", "category_code",
        D.describe(D.capitalized("w1"), D.capitalized("w2"), "benefit", F.col("w2").endswith("s"),
                   "product_id").alias("description"),
        D.price_with_ending("price", "product_id").cast("double").alias("shelf_price"))
    return D.pick_scoped(described, star.brands(spark, sf_dir), "category_code", "brand_code",
                         "product_id", "suggested_brand")


# --------------------------------------------------------------------------
# Topic routing with tombstones, event-time formats, line totals,
# schema-evolving bronze appends

TOPIC_PREFIX = "ecommerce.brz_"


@register("topic_routing", with_star(*TABLE_ORDER) + f"""
, latest AS ({_LATEST_LINES.replace("order_lines", "order_items").format(where="")}),
m AS (""" + "\nUNION ALL ".join(
    f"SELECT '{TOPIC_PREFIX}{t}' AS topic, 0 AS tomb FROM {t}" for t in TABLE_ORDER if t != "order_items") + f"""
  UNION ALL SELECT '{TOPIC_PREFIX}order_items', CASE WHEN return_flag = 'R' THEN 1 ELSE 0 END FROM latest)
SELECT topic, substr(topic, {len(TOPIC_PREFIX) + 1}) AS sink_folder,
       COUNT(*) AS published, CAST(SUM(tomb) AS BIGINT) AS tombstones,
       CAST(COUNT(*) - SUM(tomb) AS BIGINT) AS written
FROM m GROUP BY topic ORDER BY topic""")
def topic_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every star table published to its own topic (prefix + table name)
    as JSON rows; the fact topic carries the latest version per key, and a
    tombstone (null value) for each key whose latest line was returned.
    The sink ignores tombstones and writes files of at most 1000 messages
    into a folder named after the table without the prefix; the counts are
    read back from the written files."""
    from tessera.functions.standardize import strip_prefix
    from tessera.functions.wire import encode_row
    from tessera.sources.incremental import route_topic
    from tessera.streaming.jobs import drop_tombstones
    feeds = []
    for t in TABLE_ORDER:
        df = star.star_table(spark, sf_dir, t)
        if t == "order_items":
            df = latest_per_key(df, ["order_item_id"], star.fact_sort_keys())
            value = F.when(F.col("return_flag") != "R", encode_row(df.columns))
        else:
            value = encode_row(df.columns)
        feeds.append(route_topic(df, TOPIC_PREFIX, t).select(F.col("_topic").alias("topic"), value.alias("value")))
    messages = reduce(DataFrame.unionByName, feeds)
    # the sink: one folder per table, files of at most 1000 messages,
    # tombstones ignored
    path = scratch_path(spark, "topic-sink")
    (drop_tombstones(messages).withColumn("sink_folder", strip_prefix(F.col("topic"), re.escape(TOPIC_PREFIX)))
     .write.options(**GZIP).option("maxRecordsPerFile", 1000).partitionBy("sink_folder").json(path))
    written = spark.read.schema("topic string, value string, sink_folder string").json(path)
    pub = messages.groupBy("topic").agg(F.count(F.lit(1)).alias("published"),
                                        F.count(F.when(F.col("value").isNull(), 1)).alias("tombstones"))
    out = written.groupBy("topic", "sink_folder").agg(F.count(F.lit(1)).alias("written"))
    return pub.join(out, "topic", "left").select(
        "topic", "sink_folder", "published", "tombstones",
        F.coalesce("written", F.lit(0)).cast("bigint").alias("written")).orderBy("topic")


@register("event_time_formats", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS event_time_iso,
       strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS event_minute,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date,
       CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INTEGER) AS date_code,
       CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS event_millis
FROM events""")
def event_time_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as ISO text, minute buckets, date text, date code and
    epoch millis."""
    from tessera.functions import time as TM
    ev = star.read_table(spark, sf_dir, "events")
    return ev.select(
        "event_id", TM.iso_timestamp_text("ts").alias("event_time_iso"),
        F.date_format(TM.minute_floor("ts"), "yyyy-MM-dd HH:mm").alias("event_minute"),
        F.to_date("ts").cast("string").alias("event_date"), TM.date_code("ts").alias("date_code"),
        TM.ntz_millis("ts").alias("event_millis"))


@register("fact_line_totals", with_star("order_lines", "products") + """
SELECT l.order_item_id, l.product_id, CAST(l.quantity AS DOUBLE) AS quantity, CAST(p.price AS DOUBLE) AS unit_price,
       CAST(round(p.price * l.quantity, 2) AS DOUBLE) AS line_total
FROM order_lines l JOIN products p ON p.product_id = l.product_id""")
def fact_line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact lines priced from the catalogue: unit price times quantity,
    rounded to cents in exact decimal arithmetic."""
    lines = star.order_lines(spark, sf_dir).select("order_item_id", "product_id", "quantity")
    prices = star.products(spark, sf_dir).select("product_id", F.col("price").alias("unit_price"))
    return attach(lines, prices, "product_id", "inner").select(
        "order_item_id", "product_id", F.col("quantity").cast("double").alias("quantity"), F.col("unit_price").cast("double").alias("unit_price"),
        D.line_total("unit_price", "quantity").cast("double").alias("line_total"))


@register("bronze_schema_evolution", with_star("customers") + """
SELECT '2024-01-01' AS processing_date, COUNT(*) AS row_count, CAST(0 AS BIGINT) AS rows_with_city FROM customers
UNION ALL
SELECT '2024-01-02', COUNT(*), COUNT(city) FROM customers
ORDER BY processing_date""")
def bronze_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily appends to one bronze table, the second with a column the
    first lacked; read back with merged schemas, the older day has NULLs."""
    from tessera.sinks.bronze import PROCESSING_DATE, append_evolving, read_evolving
    path = scratch_path(spark, "evolving")
    cust = star.customers(spark, sf_dir)
    append_evolving(with_bronze_metadata(cust.drop("city"), "2024-01-01"), path)
    append_evolving(with_bronze_metadata(cust, "2024-01-02"), path)
    back = read_evolving(spark, path)
    return back.groupBy(F.col(PROCESSING_DATE).cast("string").alias("processing_date")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("city").alias("rows_with_city")).orderBy("processing_date")
