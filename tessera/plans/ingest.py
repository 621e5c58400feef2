"""Ingest plans: landings, bronze loads, format probing, CSV parsing,
silver/gold Parquet layers, snapshots, compaction and retention.

Every plan writes into a fresh directory under the shared checkpoint
folder (``spark.checkpoint.dir``), reads the result back and returns it,
so the returned frame is what a downstream job would see.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import time as TM
from tessera.plans import register
from tessera.plans.analytics import TABLE_ORDER, _money_out
from tessera.plans.oracle_star import with_star
from tessera.session import scratch_path
from tessera.sinks import bronze as B
from tessera.sinks import files as SK
from tessera.sources import files as SRC
from tessera.sources import star

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])

_EVENT_SQL = ("event_id, user_id, event_type, value, props, "
              "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time")


def _events_out(df: DataFrame, parts: bool = True) -> DataFrame:
    cols = ["event_id", "user_id", "event_type", "value", "props",
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time")]
    return df.select(*cols, *(SRC.PARTITION_COLS if parts else []))


def events_landing(spark: SparkSession, sf_dir: str, name: str = "landing") -> str:
    """Land the events table as hour-partitioned NDJSON (100 rows per file)."""
    path = scratch_path(spark, name)
    SK.write_hour_partitioned(star.read_table(spark, sf_dir, "events"), path, "ts", 100)
    return path


_PARTS_SQL = ("strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, "
              "strftime(ts, '%H') AS hour")


@register("landing_hour_roundtrip", f"SELECT {_EVENT_SQL}, {_PARTS_SQL} FROM events")
def landing_hour_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events -> year/month/day/hour NDJSON landing -> read back with
    partition discovery and an explicit schema."""
    path = events_landing(spark, sf_dir)
    return _events_out(SRC.read_landing(spark, path, EVENT_SCHEMA))


@register("landing_day_slice", f"""
SELECT {_EVENT_SQL}, {_PARTS_SQL} FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-16'""")
def landing_day_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day of the landing, selected by partition predicates (the plan
    shows PartitionFilters; other days' directories are not listed)."""
    path = events_landing(spark, sf_dir)
    return _events_out(SRC.day_slice(SRC.read_landing(spark, path, EVENT_SCHEMA), "2024", "01", "16"))


@register("landing_compaction", """
SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, COUNT(*) AS events
FROM events GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""")
def landing_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small-file landing rewritten into few large files per hour directory."""
    src = events_landing(spark, sf_dir)
    dst = scratch_path(spark, "compacted")
    schema = T.StructType(EVENT_SCHEMA.fields + [T.StructField(c, T.StringType()) for c in SRC.PARTITION_COLS])
    SK.compact(spark, src, dst, SRC.PARTITION_COLS, "json", schema)
    back = SRC.read_landing(spark, dst, EVENT_SCHEMA)
    return back.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("events")).orderBy("year", "month", "day")


RETAIN_FROM = "2024-01-20"


@register("landing_retention", f"""
SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, COUNT(*) AS events
FROM events WHERE CAST(ts AS DATE) >= DATE '{RETAIN_FROM}' GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""")
def landing_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention: day directories older than the cutoff are deleted."""
    path = events_landing(spark, sf_dir)
    SK.drop_partitions_before(spark, path, RETAIN_FROM)
    back = SRC.read_landing(spark, path, EVENT_SCHEMA)
    return back.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("events")).orderBy("year", "month", "day")


# --------------------------------------------------------------------------
# Bronze: NDJSON landing per table -> idempotent date-partition loads

RUN_DATE = "2026-08-16"
NEXT_RUN_DATE = "2026-08-17"


def load_bronze_table(spark: SparkSession, sf_dir: str, table: str, root: str) -> int:
    """Land one star table as NDJSON, then load it into the bronze table
    for RUN_DATE twice (the rerun must not duplicate) and for NEXT_RUN_DATE
    once.  Returns the rows of the RUN_DATE partition."""
    src = star.star_table(spark, sf_dir, table)
    landing = f"{root}/landing/{table}"
    src.write.mode("overwrite").options(**SK.GZIP).option("maxRecordsPerFile", 5000).json(landing)
    raw = SRC.read_ndjson(spark, landing, src.schema)
    good, bad = SRC.split_corrupt(raw)
    bad.write.mode("overwrite").json(f"{root}/quarantine/{table}")
    bronze_path = f"{root}/bronze/{table}"
    for run in (RUN_DATE, RUN_DATE, NEXT_RUN_DATE):
        B.reload_partition(B.with_bronze_metadata(good, run, source_file=True), bronze_path)
    back = spark.read.parquet(bronze_path)
    return back.where(F.col(B.PROCESSING_DATE) == F.lit(RUN_DATE).cast("date")).count()


@register("bronze_load_all_tables", with_star(*TABLE_ORDER) + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS \"table\", 'SUCCESS' AS status, COUNT(*) AS rows, CAST(NULL AS VARCHAR) AS error FROM {t}"
    for t in TABLE_ORDER) + "\nORDER BY 1")
def bronze_load_all_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many-table bronze run with per-table error isolation; the summary
    frame has one row per table (status, rows of the reloaded day)."""
    root = scratch_path(spark, "bronze-run")
    res = B.run_tables(spark, TABLE_ORDER, lambda t: load_bronze_table(spark, sf_dir, t, root))
    return res.orderBy("table")


_LINES_SQL = ("order_item_id, order_id, product_id, supplier_id, date_code, CAST(quantity AS DOUBLE) AS quantity, "
              "CAST(total_price AS DOUBLE) AS total_price, CAST(discount AS DOUBLE) AS discount, "
              "CAST(tax AS DOUBLE) AS tax, return_flag, line_status, dt_update")
_LINE_COLS = ["order_item_id", "order_id", "product_id", "supplier_id", "date_code", "quantity",
              "total_price", "discount", "tax", "return_flag", "line_status", "dt_update"]


@register("bronze_partitions", with_star("order_lines") + f"""
SELECT CAST(d AS VARCHAR) AS processing_date, COUNT(*) AS rows
FROM order_lines, (VALUES (DATE '{RUN_DATE}'), (DATE '{NEXT_RUN_DATE}')) v(d)
GROUP BY 1 ORDER BY 1""")
def bronze_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact bronze after loading RUN_DATE twice and NEXT_RUN_DATE once:
    each date holds the table once; the processing date reads back as DATE."""
    root = scratch_path(spark, "bronze-fact")
    lines = star.order_lines(spark, sf_dir)
    landing = f"{root}/landing"
    lines.write.mode("overwrite").options(**SK.GZIP).option("maxRecordsPerFile", 5000).json(landing)
    good, _ = SRC.split_corrupt(SRC.read_ndjson(spark, landing, lines.schema))
    path = f"{root}/bronze"
    for run in (RUN_DATE, RUN_DATE, NEXT_RUN_DATE):
        B.reload_partition(B.with_bronze_metadata(good, run, source_file=True), path)
    back = spark.read.parquet(path)
    return (back.groupBy(F.col(B.PROCESSING_DATE).cast("string").alias("processing_date"))
            .agg(F.count(F.lit(1)).alias("rows")).orderBy("processing_date"))


@register("bronze_rows", with_star("order_lines") + f"""
SELECT order_item_id, order_id, product_id, dt_update, 36 AS row_id_length, true AS has_source_file, true AS has_ingestion_time,
       '{RUN_DATE}' AS processing_date
FROM order_lines""")
def bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze fact's rows with their lineage: row id, source file (one of
    the landing's), ingestion time, processing date."""
    root = scratch_path(spark, "bronze-rows")
    lines = star.order_lines(spark, sf_dir)
    lines.write.options(**SK.GZIP).option("maxRecordsPerFile", 5000).json(f"{root}/landing")
    good, _ = SRC.split_corrupt(SRC.read_ndjson(spark, f"{root}/landing", lines.schema))
    B.reload_partition(B.with_bronze_metadata(good, RUN_DATE, source_file=True), f"{root}/bronze", day=RUN_DATE)
    return spark.read.parquet(f"{root}/bronze").select(
        "order_item_id", "order_id", "product_id", "dt_update", F.length("_row_id").alias("row_id_length"),
        F.col("_source_file").contains("/landing/part-").alias("has_source_file"),
        F.col("_ingested_at").isNotNull().alias("has_ingestion_time"),
        F.col(B.PROCESSING_DATE).cast("string").alias("processing_date"))


@register("bronze_reload_empty_day", with_star("order_lines") + f"""
SELECT '{NEXT_RUN_DATE}' AS processing_date, COUNT(*) AS rows FROM order_lines""")
def bronze_reload_empty_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days loaded, the first then reloaded from an empty input: its rows
    go, the other day's stay."""
    path = f"{scratch_path(spark, 'bronze-empty')}/bronze"
    lines = star.order_lines(spark, sf_dir)
    for day in (RUN_DATE, NEXT_RUN_DATE):
        B.reload_partition(B.with_bronze_metadata(lines, day), path, day=day)
    B.reload_partition(B.with_bronze_metadata(lines.limit(0), RUN_DATE), path, day=RUN_DATE)
    return spark.read.parquet(path).groupBy(F.col(B.PROCESSING_DATE).cast("string").alias("processing_date")) \
        .agg(F.count(F.lit(1)).alias("rows"))


@register("json_format_probe", with_star("order_lines") + f"""
SELECT 'good' AS side, {_LINES_SQL} FROM order_lines WHERE NOT (return_flag = 'N' AND order_id % 50 = 0)
UNION ALL SELECT 'quarantined', order_item_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM order_lines WHERE return_flag = 'N' AND order_id % 50 = 0""")
def json_format_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing mixing NDJSON files, some of whose lines were cut short, and
    JSON-array files (rows with return flag R): every file is read in its own
    layout, cut lines are quarantined with their raw text, and good plus
    quarantined rows are the input (reading everything with multiLine would
    keep only the first record of each NDJSON file)."""
    root = scratch_path(spark, "mixed-json")
    lines = star.order_lines(spark, sf_dir)
    text = F.to_json(F.struct(*lines.columns))
    cut = (F.col("return_flag") == "N") & (F.col("order_id") % 50 == 0)
    lines.where(F.col("return_flag") != "R").select(F.when(cut, F.left(text, F.lit(60))).otherwise(text).alias("value")) \
        .write.options(**SK.GZIP).option("maxRecordsPerFile", 5000).text(f"{root}/ndjson")
    SK.write_json_array_parts(lines.where(F.col("return_flag") == "R"), f"{root}/arrays")
    good, bad = SRC.read_json_auto(spark, [f"{root}/ndjson", f"{root}/arrays"], lines.schema)
    good = _money_out(good).select(F.lit("good").alias("side"), *_LINE_COLS)
    key = F.regexp_extract("raw", '"order_item_id":"([^"]*)"', 1)
    quarantined = bad.select(F.lit("quarantined").alias("side"), key.alias("order_item_id"))
    return good.unionByName(quarantined, allowMissingColumns=True)


@register("corrupt_record_split", with_star("order_lines") + """
SELECT 'good' AS side, COUNT(*) AS rows FROM order_lines WHERE return_flag <> 'N'
UNION ALL SELECT 'bad', COUNT(*) FROM order_lines WHERE return_flag = 'N'
ORDER BY side""")
def corrupt_record_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NDJSON where the lines of return flag N were cut short: good rows
    load, every cut line goes to quarantine with its raw text."""
    root = scratch_path(spark, "corrupt-json")
    lines = star.order_lines(spark, sf_dir)
    js = F.to_json(F.struct(*lines.columns))
    text = lines.select(F.when(F.col("return_flag") == "N", F.expr("substring(to_json(struct(*)), 1, 25)"))
                        .otherwise(js).alias("value"))
    text.write.mode("overwrite").text(f"{root}/raw")
    raw = SRC.read_ndjson(spark, f"{root}/raw", lines.schema)
    good, bad = SRC.split_corrupt(raw)
    good.write.mode("overwrite").parquet(f"{root}/good")
    bad.write.mode("overwrite").parquet(f"{root}/bad")
    g = spark.read.parquet(f"{root}/good").agg(F.count(F.lit(1)).alias("rows")).select(F.lit("good").alias("side"), "rows")
    b = spark.read.parquet(f"{root}/bad").agg(F.count(F.lit(1)).alias("rows")).select(F.lit("bad").alias("side"), "rows")
    return g.unionByName(b).orderBy("side")


@register("raw_text_sample", """
SELECT event_id, user_id, event_type FROM (
  SELECT event_id, user_id, event_type, CAST(event_id AS VARCHAR) || '|' || CAST(user_id AS VARCHAR) || '|' || event_type AS line
  FROM events) t ORDER BY line LIMIT 5""")
def raw_text_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five raw lines, in text order, of a landing of events, shown
    as fields (inspection of unreadable input)."""
    root = scratch_path(spark, "text-sample")
    events = star.read_table(spark, sf_dir, "events")
    events.select(F.concat_ws("|", "event_id", "user_id", "event_type").alias("value")).write.text(root)
    fields = F.split("value", r"\|")
    return SRC.read_text_sample(spark, root, 5).select(
        fields[0].cast("bigint").alias("event_id"), fields[1].cast("bigint").alias("user_id"), fields[2].alias("event_type"))


# --------------------------------------------------------------------------
# Decimal-comma CSV (bond-style source file)

CSV_COLUMNS = ["Id", "Tipo Titulo", "Data Vencimento", "Taxa Compra Manha", "PU Compra Manha"]


@register("csv_decimal_comma", """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id, l_returnflag AS tipo,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS data_vencimento,
       CAST(CAST(l_discount * 100 AS DECIMAL(8,2)) AS DOUBLE) AS taxa_compra,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS pu_compra
FROM lineitem""")
def csv_decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """';'-separated CSV with decimal commas and day-first dates, parsed back
    into typed columns and renamed."""
    root = scratch_path(spark, "csv")
    li = star.read_table(spark, sf_dir, "lineitem")
    comma = lambda c: F.regexp_replace(c.cast("string"), r"\.", ",")
    out = li.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias(CSV_COLUMNS[0]),
                    F.col("l_returnflag").alias(CSV_COLUMNS[1]),
                    F.date_format("l_shipdate", "dd/MM/yyyy").alias(CSV_COLUMNS[2]),
                    comma((F.col("l_discount") * 100).cast("decimal(8,2)")).alias(CSV_COLUMNS[3]),
                    comma(F.col("l_extendedprice").cast("decimal(12,2)")).alias(CSV_COLUMNS[4]))
    out.write.mode("overwrite").option("header", "true").option("sep", ";").csv(root)
    parsed = SRC.read_decimal_comma_csv(spark, root, CSV_COLUMNS,
                                        {"Taxa Compra Manha": "decimal(8,2)", "PU Compra Manha": "decimal(12,2)"},
                                        ["Data Vencimento"])
    renamed = parsed.withColumnsRenamed({"Id": "id", "Tipo Titulo": "tipo", "Data Vencimento": "data_vencimento",
                                         "Taxa Compra Manha": "taxa_compra", "PU Compra Manha": "pu_compra"})
    return renamed.select("id", "tipo", F.col("data_vencimento").cast("string").alias("data_vencimento"),
                          F.col("taxa_compra").cast("double").alias("taxa_compra"),
                          F.col("pu_compra").cast("double").alias("pu_compra"))


# --------------------------------------------------------------------------
# Silver and gold Parquet layers (bond-price pipeline on lineitem)


def bond_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bond-like rows: type = return flag, buy price = extended price, sell
    price = price net of discount, maturity and update as epoch millis."""
    li = star.read_table(spark, sf_dir, "lineitem")
    buy = F.col("l_extendedprice").cast("decimal(12,2)")
    return li.select(
        F.col("l_returnflag").alias("Tipo"),
        buy.alias("PUCompraManha"),
        (buy * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(14,4)").alias("PUVendaManha"),
        TM.ntz_millis("l_shipdate").alias("Data_Vencimento"),
        TM.ntz_millis("l_shipdate").alias("dt_update"))


def bond_silver(spark: SparkSession, sf_dir: str) -> str:
    """Silver: whole-row dedup, epoch millis rendered as text, null prices
    set to zero; written as Parquet and returned as its path."""
    from tessera.functions.standardize import fill_zero
    silver = bond_rows(spark, sf_dir).dropDuplicates()
    silver = silver.withColumns({"Data_Vencimento": TM.millis_to_date_text("Data_Vencimento"),
                                 "dt_update": TM.millis_to_timestamp_text("dt_update")})
    silver = fill_zero(silver, ["PUCompraManha", "PUVendaManha"])
    path = scratch_path(spark, "silver-bonds")
    SK.write_layer(silver, path)
    return path


_BOND_DISTINCT = """(SELECT DISTINCT l_returnflag AS Tipo, CAST(l_extendedprice AS DECIMAL(12,2)) AS pc,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(14,4)) AS pv,
       l_shipdate FROM lineitem)"""


@register("gold_price_by_type", f"""
SELECT Tipo, CAST(SUM(pc) AS DOUBLE) / COUNT(*) AS Media_PUCompraManha,
       CAST(SUM(pv) AS DOUBLE) / COUNT(*) AS Media_PUVendaManha, COUNT(*) AS Total_Registros
FROM {_BOND_DISTINCT} b GROUP BY Tipo ORDER BY Tipo""")
def gold_price_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold from the silver Parquet (only three columns are read)."""
    silver = spark.read.parquet(bond_silver(spark, sf_dir))
    gold = silver.groupBy("Tipo").agg(
        (F.sum("PUCompraManha").cast("double") / F.count(F.lit(1))).alias("Media_PUCompraManha"),
        (F.sum("PUVendaManha").cast("double") / F.count(F.lit(1))).alias("Media_PUVendaManha"),
        F.count(F.lit(1)).alias("Total_Registros"))
    path = scratch_path(spark, "gold-bonds")
    SK.write_layer(gold, path)
    return spark.read.parquet(path).orderBy("Tipo")


@register("type_counts", f"SELECT Tipo, COUNT(*) AS total FROM {_BOND_DISTINCT} b GROUP BY Tipo ORDER BY Tipo")
def type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = spark.read.parquet(bond_silver(spark, sf_dir))
    return silver.groupBy("Tipo").agg(F.count(F.lit(1)).alias("total")).orderBy("Tipo")


@register("silver_date_text", f"""
SELECT DISTINCT Tipo, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS Data_Vencimento,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS dt_update, CAST(pc AS DOUBLE) AS PUCompraManha
FROM {_BOND_DISTINCT} b""")
def silver_date_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = spark.read.parquet(bond_silver(spark, sf_dir))
    return silver.select("Tipo", "Data_Vencimento", "dt_update",
                         F.col("PUCompraManha").cast("double").alias("PUCompraManha")).distinct()


# --------------------------------------------------------------------------
# Snapshot sink


@register("snapshot_sink_roundtrip", with_star(*TABLE_ORDER) + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS rows FROM {t}" for t in TABLE_ORDER) + "\nORDER BY table_name")
def snapshot_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each table written as a JSON snapshot named after the newest fact
    version (brz_ prefix stripped from the directory), written twice: the
    second write replaces the first."""
    root = scratch_path(spark, "snapshots")
    stamp_row = star.order_lines(spark, sf_dir).agg(
        TM.file_stamp(TM.millis_to_ntz(F.max("dt_update"))).alias("s")).first()
    stamp = stamp_row["s"]  # one value: the name of this snapshot run
    frames = []
    for t in TABLE_ORDER:
        df = star.star_table(spark, sf_dir, t)
        for _ in range(2):
            path = SK.write_snapshot(df, root, f"brz_{t}", stamp)
        frames.append(spark.read.schema(df.schema).json(path).agg(F.count(F.lit(1)).alias("rows"))
                      .select(F.lit(t).alias("table_name"), "rows"))
    return reduce(DataFrame.unionByName, frames).orderBy("table_name")
