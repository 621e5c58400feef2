"""Registry of contract versions, and the class of each change between them.

A registered version is one row per column (``sinks/versioned`` commits it
whole, numbered after the newest of its table).  ``changes`` compares every
version with the one before it by one full outer join on (table, version,
column) and classifies each difference under the evolution policy of
``contracts.classify_change``, for all tables and versions at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.quality.contracts import Contract
from tessera.sinks import versioned

COLUMNS = ["column_name", "type", "required", "in_key"]


def columns_of(spark: SparkSession, contract: Contract) -> DataFrame:
    """A declared contract as rows."""
    return spark.createDataFrame([(c.name, c.type, not c.nullable, c.name in contract.key) for c in contract.columns],
                                 "column_name string, type string, required boolean, in_key boolean")


def columns_found(landed: DataFrame, lines: int, key: list[str]) -> DataFrame:
    """The columns that ``validation.landed_columns`` found as a contract:
    required where every line has a value, numbers with a fraction DOUBLE,
    so that the digits of one load make no new type."""
    kind = F.when(F.col("found_type").startswith("decimal"), "double").when(F.col("found_type") == "void", "string").otherwise(F.col("found_type"))
    return landed.select("column_name", kind.alias("type"), (F.col("rows") == lines).alias("required"), F.col("column_name").isin(key).alias("in_key"))


def register(spark: SparkSession, root: str, table: str, columns: DataFrame) -> int:
    """Add a version of ``table``; returns its number (1 for the first)."""
    marks = versioned.load(spark, root).marks
    number = marks.get(table, 0) + 1
    rows = columns.select(F.lit(table).alias("table_name"), F.lit(number).alias("version"), *COLUMNS)
    versioned.append(rows, root, "table_name", {table: number})
    return number


def _widens(old: Column, new: Column) -> Column:
    """Types whose values all fit the newer one."""
    order = F.array(*[F.lit(t) for t in ("tinyint", "smallint", "int", "bigint")])
    whole = (F.array_position(order, old) > 0) & (F.array_position(order, new) >= F.array_position(order, old))
    digits = lambda t, k: F.regexp_extract(t, r"^decimal\((\d+),(\d+)\)$", k).try_cast("int")
    scale = digits(new, 2) >= digits(old, 2)
    room = digits(new, 1) - digits(new, 2) >= digits(old, 1) - digits(old, 2)
    pairs = F.concat_ws(">", old, new).isin("float>double", "int>double", "bigint>decimal(20,0)")
    return F.coalesce(whole, F.lit(False)) | F.coalesce(scale & room, F.lit(False)) | pairs


def changes(registered: DataFrame) -> DataFrame:
    """table_name, from_version, to_version, column_name, change, kind: what
    each version changed against the one before it."""
    new = registered.select("table_name", F.col("version").alias("to_version"), "column_name", F.struct(*COLUMNS[1:]).alias("new"))
    old = registered.select("table_name", (F.col("version") + 1).alias("to_version"), "column_name", F.struct(*COLUMNS[1:]).alias("old"))
    newest = registered.groupBy("table_name").agg(F.max("version").alias("newest"))
    both = new.join(old, ["table_name", "to_version", "column_name"], "full_outer").join(newest, "table_name") \
        .where((F.col("to_version") > 1) & (F.col("to_version") <= F.col("newest")))
    kind = lambda additive: F.when(additive, "additive").otherwise("breaking")
    item = lambda change, of: F.struct(change.alias("change"), of.alias("kind"))
    here = F.col("old").isNotNull() & F.col("new").isNotNull()
    found = F.array(
        F.when(F.col("new").isNull(), item(F.lit("removed"), F.lit("breaking"))),
        F.when(F.col("old").isNull(), item(F.lit("added"), kind(~F.col("new.required")))),
        F.when(here & (F.col("old.type") != F.col("new.type")),
               item(F.concat(F.lit("type "), F.col("old.type"), F.lit(" -> "), F.col("new.type")), kind(_widens(F.col("old.type"), F.col("new.type"))))),
        F.when(here & (F.col("old.required") != F.col("new.required")),
               item(F.when(F.col("new.required"), "required").otherwise("nullable"), kind(~F.col("new.required")))),
        F.when(here & (F.col("old.in_key") != F.col("new.in_key")), item(F.lit("key changed"), F.lit("breaking"))))
    each = both.select("table_name", (F.col("to_version") - 1).alias("from_version"), "to_version", "column_name",
                       F.explode(F.filter(found, lambda c: c.isNotNull())).alias("c"))
    return each.select("table_name", "from_version", "to_version", "column_name", "c.change", "c.kind")
