"""Order-dependent plans: surrogate keys, round-robin assignment,
carry-forward, seeded samples and a topic log with per-partition offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import sequence as SEQ
from tessera.plans import register
from tessera.plans.analytics import _money_out
from tessera.plans.oracle_star import with_star
from tessera.session import guarded_broadcast, scratch_path
from tessera.sources import kafka, star


@register("customer_surrogate_keys", with_star("customers") + """
SELECT customer_id, printf('cust_%06d', row_number() OVER (ORDER BY customer_id)) AS customer_key
FROM customers""")
def customer_surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequential keys cust_000001, ... in customer order."""
    idx = SEQ.consecutive_index(star.customers(spark, sf_dir).select("customer_id"), ["customer_id"], "i")
    return idx.select("customer_id", SEQ.surrogate_key("i", "cust_", 6).alias("customer_key"))


@register("brand_round_robin", with_star("brands", "category") + """
, b AS (SELECT brand_code, row_number() OVER (ORDER BY brand_code) AS i FROM brands),
c AS (SELECT category_code, row_number() OVER (ORDER BY category_code) AS j FROM category),
n AS (SELECT COUNT(*) AS n FROM category)
SELECT b.brand_code, c.category_code AS assigned_category
FROM b JOIN n ON true JOIN c ON c.j = ((b.i - 1) % n.n) + 1""")
def brand_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands in code order dealt to categories in code order, round robin."""
    cats = SEQ.consecutive_index(star.category(spark, sf_dir).select("category_code"), ["category_code"], "j")
    n_cat = cats.count()  # one scalar: the number of categories
    brands = SEQ.consecutive_index(star.brands(spark, sf_dir).select("brand_code"), ["brand_code"], "i")
    slotted = brands.withColumn("j", SEQ.round_robin("i", n_cat) + 1)
    return slotted.join(guarded_broadcast(cats), "j").select(
        "brand_code", F.col("category_code").alias("assigned_category"))


@register("events_last_purchase", """
SELECT event_id, user_id, event_type,
       last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS)
         OVER (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase_id
FROM events""")
def events_last_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every event, the latest purchase so far (carried forward over the
    global time order until the next purchase)."""
    ev = star.read_table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "ts",
        F.when(F.col("event_type") == "purchase", F.col("event_id")).alias("_p"))
    out = SEQ.carry_forward(ev, "_p", ["ts", "event_id"], "last_purchase_id")
    return out.select("event_id", "user_id", "event_type", F.col("last_purchase_id").cast("bigint"))


@register("sample_products", with_star("products") + """
SELECT product_id, product_name FROM products
ORDER BY md5(CAST(product_id AS VARCHAR) || '-42'), product_id LIMIT 20""")
def sample_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty products in a seeded pseudo-random order (repeatable sample)."""
    return SEQ.first_n_shuffled(star.products(spark, sf_dir).select("product_id", "product_name"),
                                ["product_id"], 20, seed=42)


@register("topic_log_roundtrip", with_star("order_lines") + """
SELECT order_item_id, order_id, product_id, supplier_id, date_code, CAST(quantity AS DOUBLE) AS quantity,
       CAST(total_price AS DOUBLE) AS total_price, CAST(discount AS DOUBLE) AS discount,
       CAST(tax AS DOUBLE) AS tax, return_flag, line_status, dt_update, 'order_items' AS topic,
       CAST(order_id % 3 AS INTEGER) AS partition,
       row_number() OVER (PARTITION BY order_id % 3 ORDER BY dt_update, order_item_id, product_id, supplier_id,
                          quantity, total_price, discount, tax, return_flag, line_status) - 1 AS "offset"
FROM order_lines""")
def topic_log_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows published to a three-partition topic log (partition by
    order id, offsets in version order), stored, read back and decoded."""
    lines = star.order_lines(spark, sf_dir)
    order = ["dt_update", "order_item_id", "product_id", "supplier_id", "quantity", "total_price",
             "discount", "tax", "return_flag", "line_status"]
    recs = kafka.to_topic_records(lines, "order_items", ["order_item_id"], 3, F.col("order_id"), order, "dt_update")
    path = scratch_path(spark, "topic-log")
    recs.write.mode("overwrite").parquet(path)
    back = kafka.decode_values(kafka.read_topic_log(spark, path, ["order_items"]), lines.schema)
    return _money_out(back)
