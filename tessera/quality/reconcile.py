"""Layer reconciliation (source -> topic -> bronze -> silver) and the
derived loss, duplication and freshness figures.

Each layer is summarised by one aggregation (rows, distinct keys, newest
version); the comparison then runs on those few summary rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import estimated_size, measured, sized_shuffles


def layer_stats(df: DataFrame, table: str, layer: str, keys: list[str],
                version_col: str | None = None) -> DataFrame:
    """(table_name, layer, rows, distinct_keys, max_version).

    Distinct keys are counted by a two-level aggregation (per key, then
    overall), which pre-aggregates map-side whatever the key skew."""
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        (F.max(version_col) if version_col else F.lit(None).cast("bigint")).alias("_v"))
    return per_key.agg(
        F.sum("_n").cast("bigint").alias("rows"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_keys"),
        F.max("_v").cast("bigint").alias("max_version"),
    ).select(F.lit(table).alias("table_name"), F.lit(layer).alias("layer"),
             F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"), "distinct_keys", "max_version")


def layers_stats(spark, layers: list[tuple[str, str, DataFrame, list[str], str | None]]) -> DataFrame:
    """``layer_stats`` of many (table, layer, frame, keys, version column)
    at once, as one two-level aggregation over the union of their
    (table, layer, key, version) rows: two shuffles for all layers instead
    of two per layer.  One weightless marker row per layer keeps empty
    layers in the result (rows 0, distinct keys 0)."""
    def key_of(keys: list[str]) -> Column:
        return F.col(keys[0]).cast("string") if len(keys) == 1 else F.to_json(F.struct(*keys))

    rows = [df.select(F.lit(t).alias("table_name"), F.lit(layer).alias("layer"), key_of(keys).alias("_k"),
                      (F.col(ver).cast("bigint") if ver else F.lit(None).cast("bigint")).alias("_ver"),
                      F.lit(1).alias("_w"))
            for t, layer, df, keys, ver in layers]
    markers = spark.createDataFrame([(t, layer) for t, layer, *_ in layers], "table_name string, layer string") \
        .select("table_name", "layer", F.lit(None).cast("string").alias("_k"),
                F.lit(None).cast("bigint").alias("_ver"), F.lit(0).alias("_w"))
    per_key = reduce(DataFrame.unionByName, rows + [markers]).groupBy("table_name", "layer", "_k").agg(
        F.sum("_w").alias("_n"), F.max("_ver").alias("_v"))
    return per_key.groupBy("table_name", "layer").agg(
        F.sum("_n").cast("bigint").alias("rows"),
        F.count(F.when(F.col("_n") > 0, 1)).cast("bigint").alias("distinct_keys"),
        F.max("_v").cast("bigint").alias("max_version"))


def reconcile(stats: list[DataFrame], source_layer: str = "source") -> DataFrame:
    """Compare every layer with the source layer of the same table:
    loss_rate = 1 - distinct_keys / source distinct_keys,
    duplication_rate = 1 - distinct_keys / rows,
    lag_ms = source max_version - layer max_version."""
    allstats = reduce(DataFrame.unionByName, stats)
    w = Window.partitionBy("table_name")
    src_keys = F.max(F.when(F.col("layer") == source_layer, F.col("distinct_keys"))).over(w)
    src_ver = F.max(F.when(F.col("layer") == source_layer, F.col("max_version"))).over(w)
    return allstats.select(
        "table_name", "layer", "rows", "distinct_keys",
        F.when(src_keys > 0, 1 - F.col("distinct_keys") / src_keys).alias("loss_rate"),
        F.when(F.col("rows") > 0, 1 - F.col("distinct_keys") / F.col("rows")).alias("duplication_rate"),
        (src_ver - F.col("max_version")).alias("lag_ms"),
    )


def windowed_reconcile(layers: list[tuple[str, DataFrame]], window_col: str, key_col: str, version_col: str) -> DataFrame:
    """Layers 'source', 'topic', 'bronze' (and 'silver' = bronze's distinct
    keys) compared per window and over all ('all'): (time_window, layer,
    row_count, distinct_keys, lost_keys, loss_rate, duplication_rate, lag_ms).
    A layer without rows in one of the source's windows counts as 0 rows.

    Keys are counted by aggregation at two levels, combined before the
    shuffle, so a hot key or month is no hot task.  The layers of a key are
    columns of one row, so the second level moves a row per key, not per key
    and layer.  What is compared in the end is one row per window: it is
    counted at once, under shuffles sized by the layers, and read back."""
    names = [layer for layer, _ in layers]
    rows = reduce(DataFrame.unionByName, [df.select(
        F.lit(layer).alias("layer"), F.col(window_col).alias("w"), F.col(key_col).alias("k"),
        F.col(version_col).cast("bigint").alias("v")) for layer, df in layers])
    n, v = [f"n_{x}" for x in names], [f"v_{x}" for x in names]
    per_key = rows.groupBy("w", "k").agg(
        *[F.count(F.when(F.col("layer") == x, 1)).alias(f"n_{x}") for x in names],
        *[F.max(F.when(F.col("layer") == x, F.col("v"))).alias(f"v_{x}") for x in names])
    # a layer without rows in a window has no figures there
    counts = [F.when(F.sum(f"n_{x}") > 0, F.struct(
        F.sum(f"n_{x}").alias("row_count"), F.count(F.when(F.col(f"n_{x}") > 0, 1)).alias("distinct_keys"),
        F.max(f"v_{x}").alias("version"))).alias(x) for x in names]
    months = per_key.groupBy("w").agg(*counts).select(F.col("w").cast("string").alias("time_window"), *names)
    whole = per_key.groupBy("k").agg(*[F.sum(c).alias(c) for c in n], *[F.max(c).alias(c) for c in v]) \
        .agg(*counts).select(F.lit("all").alias("time_window"), *names)
    with sized_shuffles(rows.sparkSession, estimated_size(rows)):
        found = measured(months.unionByName(whole), "reconcile_windows")
    silver = F.when(F.col("bronze").isNotNull(), F.struct(
        F.col("bronze.distinct_keys").alias("row_count"), F.col("bronze.distinct_keys").alias("distinct_keys"),
        F.col("bronze.version").alias("version")))
    wide = found.withColumn("silver", silver)
    names = ["source", "topic", "bronze", "silver"]
    each = wide.where(F.col("source").isNotNull()).select("time_window", "source", F.explode(F.array(
        *[F.struct(F.lit(n).alias("layer"), F.col(n).alias("s")) for n in names])).alias("e"))
    keys, total = F.coalesce("e.s.distinct_keys", F.lit(0)), F.coalesce("e.s.row_count", F.lit(0))
    return each.select(
        "time_window", "e.layer", total.alias("row_count"), keys.alias("distinct_keys"),
        (F.col("source.distinct_keys") - keys).alias("lost_keys"), (1 - keys / F.col("source.distinct_keys")).alias("loss_rate"),
        F.when(total > 0, 1 - keys / total).alias("duplication_rate"),
        (F.col("source.version") - F.col("e.s.version")).alias("lag_ms"))


def row_set_difference(source: DataFrame, dest: DataFrame) -> DataFrame:
    """Rows (with multiplicity) present in one side only:
    (side, row columns...) with side 'source_only' or 'dest_only'."""
    cols = source.columns
    a = source.exceptAll(dest.select(*cols)).withColumn("side", F.lit("source_only"))
    b = dest.select(*cols).exceptAll(source).withColumn("side", F.lit("dest_only"))
    return a.unionByName(b).select("side", *cols)
