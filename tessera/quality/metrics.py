"""Table-level counts and quality metrics in long format."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count, status) with status OK when non-empty."""
    frames = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, df in tables.items()]
    out = reduce(DataFrame.unionByName, frames)
    return out.withColumn("status", F.when(F.col("row_count") > 0, "OK").otherwise("EMPTY")) \
        .orderBy("table_name")


def expected_vs_actual(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Join expected row counts (table_name, expected_rows) to actual counts
    (table_name, row_count) and flag MATCH / MISMATCH / MISSING."""
    j = expected.join(actual.select("table_name", "row_count"), "table_name", "left")
    return j.withColumn("check", F.when(F.col("row_count").isNull(), "MISSING")
                        .when(F.col("row_count") == F.col("expected_rows"), "MATCH")
                        .otherwise("MISMATCH"))


def distinct_counts(targets: list[tuple[str, DataFrame, str]], approx: bool = False,
                    rsd: float = 0.01) -> DataFrame:
    """(metric, distinct_values) for each (metric name, frame, column).

    Exact counts shuffle every distinct value once (after map-side
    de-duplication); ``approx=True`` uses HyperLogLog++ sketches of fixed
    size per task instead, merged in one small final step, with relative
    standard deviation ``rsd``: the choice for very large columns."""
    agg = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.countDistinct
    frames = [df.agg(agg(col).cast("bigint").alias("distinct_values")).select(F.lit(m).alias("metric"),
                                                                            "distinct_values")
              for m, df, col in targets]
    return reduce(DataFrame.unionByName, frames)


SKETCH_BITS = 12  # log2 of the registers: relative standard error 0.83 / sqrt(2^12), 1.3 %


def daily_sketches(df: DataFrame, day, column: str, bits: int = SKETCH_BITS) -> DataFrame:
    """(day, sketch, rows): a HyperLogLog sketch of ``column`` per day, of
    fixed size whatever the day holds.  Stored, it answers distinct counts
    over any set of days without their rows."""
    return df.groupBy(day.alias("day")).agg(F.hll_sketch_agg(column, F.lit(bits)).alias("sketch"), F.count(F.lit(1)).alias("rows"))


def merged_distinct(sketches: DataFrame, *by) -> DataFrame:
    """Distinct counts over groups of days, from their sketches alone."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values"), F.sum("rows").alias("rows"))
