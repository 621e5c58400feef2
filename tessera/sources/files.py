"""File sources: NDJSON, JSON arrays, format probing, corrupt-record
split, raw text, hive-partitioned landings, decimal-comma CSV.

Readers take explicit schemas: schema inference costs a full extra scan
of the input and gives drifting types between runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.standardize import decimal_comma
from tessera.functions.time import parse_day_first
from tessera.session import guarded_broadcast, measured

# Microsecond timestamp text, as written by tessera.sinks.files.
TIMESTAMP_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS][X]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]",
}

CORRUPT = "_corrupt_record"
PARTITION_COLS = ["year", "month", "day", "hour"]


def with_corrupt_column(schema: T.StructType, name: str = CORRUPT) -> T.StructType:
    if name in schema.fieldNames():
        return schema
    return T.StructType(schema.fields + [T.StructField(name, T.StringType(), True)])


def _reads(schema: T.StructType) -> F.Column:
    """Always true, but refers to a data column: Spark refuses to answer from
    a raw file's corrupt-record column alone."""
    first = next(f.name for f in schema.fields if f.name not in (CORRUPT, *PARTITION_COLS))
    return F.hash(F.col(f"`{first}`")) >= F.lit(-(1 << 31))


def read_ndjson(spark: SparkSession, path, schema: T.StructType, base_path: str | None = None,
                keep_corrupt: bool = True) -> DataFrame:
    """One JSON object per line.  Malformed lines are kept whole in
    ``_corrupt_record`` (PERMISSIVE) instead of failing the job."""
    r = spark.read.option("mode", "PERMISSIVE").option("multiLine", "false").options(**TIMESTAMP_OPTIONS)
    if keep_corrupt:
        schema = with_corrupt_column(schema)
        r = r.option("columnNameOfCorruptRecord", CORRUPT)
    if base_path:
        r = r.option("basePath", base_path)
    return r.schema(schema).json(path)


def read_json_array(spark: SparkSession, path, schema: T.StructType, base_path: str | None = None) -> DataFrame:
    """Files holding one JSON document each (an array of records or one
    pretty-printed object).  Note: on NDJSON this silently yields only the
    first record of every file, so never use it without ``probe_json``."""
    r = spark.read.option("multiLine", "true").option("mode", "PERMISSIVE").options(**TIMESTAMP_OPTIONS)
    if base_path:
        r = r.option("basePath", base_path)
    return r.schema(schema).json(path)


def _text_lines(spark: SparkSession, path) -> DataFrame:
    """file, place (order within the file), v (trimmed, non-blank)."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.trim("value").alias("v"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")).alias("place"))
    return lines.where(F.length("v") > 0)


def probe_json(spark: SparkSession, path) -> DataFrame:
    """Classify every file under ``path``: 'document' when its first character
    is ``[`` or none of its lines is a whole object, else 'ndjson' (damaged
    lines included).  One aggregation over the text lines, one row per file."""
    whole = F.col("v").startswith("{") & F.col("v").endswith("}")
    per_file = _text_lines(spark, path).groupBy("file").agg(
        F.min_by(F.substring("v", 1, 1), "place").alias("first"), F.count_if(whole).alias("objects"))
    return per_file.select("file", F.when((F.col("first") == "[") | (F.col("objects") == 0), "document")
                           .otherwise("ndjson").alias("layout"))


def read_json_auto(spark: SparkSession, path, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Read a mix of NDJSON and JSON-document files without losing rows:
    (good rows, quarantined (file, raw text)).

    The verdict per file stays a DataFrame: NDJSON lines and documents are
    both read and each kept only where the file's verdict says so.  A line
    that is no whole object of the schema, and a document that doesn't parse,
    go to quarantine whole."""
    # one row per file: broadcast where that is small, else all text is shuffled by file
    verdicts = measured(probe_json(spark, path), "verdicts")
    kept = lambda df, layout: df.join(guarded_broadcast(verdicts.where(F.col("layout") == layout)), "file", "left_semi")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **TIMESTAMP_OPTIONS}
    parsed = kept(_text_lines(spark, path), "ndjson").select(
        "file", "v", F.from_json("v", with_corrupt_column(schema), options).alias("row"))
    documents = spark.read.options(**options).option("multiLine", "true").schema(with_corrupt_column(schema)).json(path) \
        .select(F.col("_metadata.file_path").alias("file"), F.struct(*[F.col(f"`{n}`") for n in schema.fieldNames()], F.col(CORRUPT)).alias("row"))
    first = F.col(f"row.`{schema.fieldNames()[0]}`")
    documents = kept(documents, "document").where(F.hash(first) >= F.lit(-(1 << 31))).withColumn("v", F.col(f"row.{CORRUPT}"))
    both = parsed.unionByName(documents)
    good = both.where(F.col(f"row.{CORRUPT}").isNull()).select(*[F.col(f"row.`{n}`").alias(n) for n in schema.fieldNames()])
    bad = both.where(F.col(f"row.{CORRUPT}").isNotNull()).select("file", F.col("v").alias("raw"))
    return good, bad


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, bad rows with the raw text and
    source file).  Both keep the data columns in their plans: Spark refuses
    a raw JSON query that needs only the corrupt column, so write the two
    sides (or count them after writing) rather than counting bad rows alone."""
    data_cols = [c for c in df.columns if c != CORRUPT]
    good = df.where(F.col(CORRUPT).isNull()).select(*data_cols)
    bad = df.where(F.col(CORRUPT).isNotNull()).select(
        *data_cols, CORRUPT, F.col("_metadata.file_path").alias("_source_file"))
    return good, bad


def read_text_sample(spark: SparkSession, path, n: int = 5) -> DataFrame:
    """The first lines of raw text in text order, to inspect an unreadable
    input (planned as a top-k)."""
    return spark.read.text(path).orderBy("value").limit(n)


def read_landing(spark: SparkSession, base: str, schema: T.StructType, sub: str | None = None,
                 keep_corrupt: bool = False) -> DataFrame:
    """NDJSON under hive directories year=/month=/day=/hour=.  Reading a
    sub-directory keeps every partition column thanks to ``basePath``;
    the partition columns are declared as text in the schema, so '08'
    stays '08' instead of being inferred as the integer 8."""
    schema = T.StructType([f for f in schema.fields if f.name not in PARTITION_COLS]
                          + [T.StructField(c, T.StringType()) for c in PARTITION_COLS])
    path = f"{base.rstrip('/')}/{sub}" if sub else base
    rows = read_ndjson(spark, path, schema, base_path=base)
    # a malformed line is no row of NULLs: take it with keep_corrupt and split_corrupt
    return rows if keep_corrupt else rows.where(F.col(CORRUPT).isNull() & _reads(schema)).drop(CORRUPT)


def day_slice(df: DataFrame, year: str, month: str, day: str) -> DataFrame:
    """A day of a partitioned landing by predicates on the partition
    columns (PartitionFilters prune directories), not by path strings."""
    return df.where((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day))


def read_decimal_comma_csv(spark: SparkSession, path, columns: list[str], decimals: dict[str, str],
                           day_first_dates: list[str], sep: str = ";", keep: bool = False) -> DataFrame:
    """CSV with ``sep`` separators, decimal commas and dd/MM/yyyy dates.
    Read as text (no inference), then parse with tolerant casts: a bad
    value becomes NULL rather than failing the load.  With ``keep``, its
    text stays in ``_dq_uncastable`` (``quality.validation.keep_lost``)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.schema(schema).option("header", "true").option("sep", sep).csv(path)
    parsed = {**{c: decimal_comma(c, t) for c, t in decimals.items()}, **{c: parse_day_first(c) for c in day_first_dates}}
    if keep:
        from tessera.quality.validation import keep_lost
        return keep_lost(raw, {c: (c, value) for c, value in parsed.items()})
    return raw.withColumns(parsed)
