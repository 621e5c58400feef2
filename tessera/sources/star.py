"""Star-schema adapter: the e-commerce model (category, brands, customers,
calendar, products, order_items) derived from the TPC-H-style test tables.

Every table is a lazy DataFrame over the parquet scans, so column pruning
and filter push-down reach the files.  Mapping:

* order_lines / order_items <- lineitem (+ orders for the customer);
  ``order_item_id = l_orderkey-l_linenumber`` is NOT unique in the data,
  which gives the real duplicates the dedup and key checks need.
* customers <- customer + nation + region (country = nation, state = region)
* products  <- part;  brands <- distinct (p_brand, p_type);  category <- p_type
* calendar  <- every day between the first and last ship date
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import time as T
from tessera.session import estimated_size, guarded_broadcast, hashed_side

MONEY = "decimal(12,2)"
RATE = "decimal(4,2)"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one table.  Splits follow the session's
    ``spark.sql.files.maxPartitionBytes`` and ``minPartitionNum``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def brand_code(brand, ptype) -> F.Column:
    """Key of a brand within a type: both values in full, so two brands or
    types never share a code."""
    return F.concat(F.lit("BRD-"), brand, F.lit("-"), ptype)


def category_code(ptype) -> F.Column:
    return F.concat(F.lit("CAT-"), ptype)


def brand_label(brand, ptype) -> F.Column:
    """Display code of a brand: upper case, letters and digits of its name,
    then the type.  Not a key."""
    return F.concat(F.lit("BRD-"), F.upper(F.regexp_replace(brand, "[^A-Za-z0-9]", "")), F.lit("-"), F.col(ptype))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows from lineitem alone (no customer): use this whenever the
    customer is not needed, to avoid the lineitem x orders shuffle join."""
    return lines_of(read_table(spark, sf_dir, "lineitem"))


def _measures() -> dict:
    return {"quantity": F.col("l_quantity").cast(MONEY), "total_price": F.col("l_extendedprice").cast(MONEY),
            "discount": F.col("l_discount").cast(RATE), "tax": F.col("l_tax").cast(RATE)}


def lines_of(lineitem: DataFrame, *more: str) -> DataFrame:
    """Fact lines of raw lineitem rows, with the columns ``more`` kept."""
    return _named_lines(lineitem.withColumns(_measures()), *more)


def _named_lines(raw: DataFrame, *more) -> DataFrame:
    """Fact lines of raw rows that have their ``_measures``."""
    return raw.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        T.date_code("l_shipdate").alias("date_code"),
        "quantity", "total_price", "discount", "tax",
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_linestatus").alias("line_status"),
        T.ntz_millis("l_shipdate").alias("dt_update"), *more,
    )


def order_items(spark: SparkSession, sf_dir: str, custs: DataFrame | None = None) -> DataFrame:
    """Fact rows with their customer: lineitem joined to orders on the order
    key (a shuffle join of the two largest tables, hashed by order where the
    orders of a partition are few; AQE splits skewed keys).
    Keys and dates as text or code are made after the join: the shuffle moves
    numbers.  ``custs`` (by ``customer_id``) meet the orders first, and their
    other columns come last; an order without its customer is left out."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"))
    more = [c for c in custs.columns if c != "customer_id"] if custs is not None else []
    if custs is not None:
        orders = orders.join(guarded_broadcast(custs), "customer_id")
    raw = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
                                                       "l_returnflag", "l_linestatus", *[c.alias(n) for n, c in _measures().items()])
    lines = _named_lines(raw.join(hashed_side(orders), F.col("l_orderkey") == F.col("o_orderkey")), "customer_id", *more)
    return lines.select("order_item_id", "order_id", "customer_id",
                        *[c for c in lines.columns if c not in ("order_item_id", "order_id", "customer_id")])


def fact_sort_keys() -> list[str]:
    """A total order over fact versions sharing one order_item_id: newest
    first, then every value column, so dedup is deterministic."""
    return ["dt_update", "product_id", "supplier_id", "quantity", "total_price",
            "discount", "tax", "return_flag", "line_status"]


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    geo = guarded_broadcast(nation.join(guarded_broadcast(region), nation.n_regionkey == region.r_regionkey)
                            .select("n_nationkey", "n_name", "r_name"))
    return cust.join(geo, cust.c_nationkey == geo.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit("+"), (F.col("n_nationkey") + 10).cast("string"),
                 F.format_string("%09d", F.col("c_custkey"))).alias("phone"),
        F.format_string("N%02d", F.col("n_nationkey")).alias("country_code"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("state"),
        F.col("c_mktsegment").alias("city"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        brand_code(F.col("p_brand"), F.col("p_type")).alias("brand_code"),
        category_code(F.col("p_type")).alias("category_code"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        F.col("p_size").alias("size"),
    )


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    return part.select(
        brand_code(F.col("p_brand"), F.col("p_type")).alias("brand_code"),
        F.col("p_brand").alias("brand_name"),
        brand_label("p_brand", "p_type").alias("brand_label"),
        category_code(F.col("p_type")).alias("category_code"),
    ).distinct()


def category(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    return part.select(category_code(F.col("p_type")).alias("category_code"),
                       F.col("p_type").alias("category_name")).distinct()


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of the fact, from its first to its last."""
    from tessera.operators.dimensions import calendar_between
    return calendar_between(_fact_bounds(spark, sf_dir))


def _fact_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").agg(
        F.min(F.to_date("l_shipdate")).alias("start"), F.max(F.to_date("l_shipdate")).alias("end"))


def calendar_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``calendar`` for foreign-key checks: its two bounds are read first
    (one pass over the date column), so the planner knows that the days
    generated from them are few and can broadcast them."""
    from tessera.operators.dimensions import calendar_between
    bounds = _fact_bounds(spark, sf_dir).first()
    days = spark.range(0 if bounds.start is None else 1)
    return calendar_between(days.select(F.lit(bounds.start).cast("date").alias("start"), F.lit(bounds.end).cast("date").alias("end")))


def day_of(date_code) -> F.Column:
    """The date of a yyyymmdd code."""
    code = F.col(date_code) if isinstance(date_code, str) else date_code
    return F.make_date(F.floor(code / 10000).cast("int"), (F.floor(code / 100) % 100).cast("int"), (code % 100).cast("int"))


STAR_TABLES = {
    "category": (category, ["category_code"]),
    "brands": (brands, ["brand_code"]),
    "customers": (customers, ["customer_id"]),
    "calendar": (calendar, ["date_code"]),
    "products": (products, ["product_id"]),
    "order_items": (order_items, ["order_item_id"]),
}


def star_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return STAR_TABLES[name][0](spark, sf_dir)


def fact_size(spark: SparkSession, sf_dir: str) -> int | None:
    """Stored bytes of the fact's source, for ``sized_shuffles``."""
    return estimated_size(read_table(spark, sf_dir, "lineitem"))


def primary_key(name: str) -> list[str]:
    return STAR_TABLES[name][1]
