"""Deduplication: latest version per business key, whole-row distinct.

``latest_per_key`` is written as an aggregation, not as
``row_number() over (partition by key order by ...)``: the aggregate
``max(struct(order keys..., payload...))`` is computed partially on the map
side, so a hot key holding a third of all rows is reduced inside every
input task before the shuffle instead of being sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str],
                   descending: bool = True, count_col: str | None = None) -> DataFrame:
    """Keep one row per ``keys``: the greatest (or least) by ``order_by``.

    ``order_by`` should make the order total (append every value column as a
    tie-break); rows equal on all of them are interchangeable.  NULLs sort
    lowest, as in ``ORDER BY ... DESC NULLS LAST``.  ``count_col`` adds the
    number of rows that the key had."""
    payload = [c for c in df.columns if c not in keys and c not in order_by]
    ranked = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)],
                      *[F.col(c) for c in payload])
    agg = F.max(ranked) if descending else F.min(ranked)
    counts = [F.count(F.lit(1)).alias(count_col)] if count_col else []
    best = df.groupBy(*keys).agg(agg.alias("_best"), *counts)
    out = best.select(*keys, *[F.col(f"_best._o{i}").alias(c) for i, c in enumerate(order_by)],
                      *[F.col(f"_best.{c}") for c in payload], *([count_col] if count_col else []))
    return out.select(*df.columns, *([count_col] if count_col else []))


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row distinct; Spark combines duplicates map-side first."""
    return df.dropDuplicates()


def duplicate_stats(df: DataFrame, keys: list[str]) -> DataFrame:
    """total rows, distinct keys and duplicate rows of ``df`` on ``keys``.

    Counted as a two-level aggregation (per key, then overall) rather than
    ``count(distinct ...)`` so multi-column keys need no concatenation."""
    whole = F.lit(True)  # like COUNT(DISTINCT ...), a key with a NULL doesn't count
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.sum("_n").cast("bigint").alias("total_rows"),
        F.count(F.when(whole, 1)).cast("bigint").alias("unique_keys"),
    ).select("total_rows", "unique_keys",
             (F.col("total_rows") - F.col("unique_keys")).alias("duplicate_rows"))
