"""Order-dependent operators without a single-partition window.

``row_number() over (order by ...)`` and ``last(x, true) over (order by
...)`` with no PARTITION BY run in one task.  Here the data is range
partitioned on the (total) order, each partition is handled locally, and
only one summary row per partition (a count, a last value) crosses
partitions -- a table whose size is bounded by the partition count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir, guarded_broadcast, measured


def _ranged(df: DataFrame, order_cols: list[str], num_partitions: int | None) -> DataFrame:
    """Range-partition and sort on the order, tag each row with its
    partition and position, and checkpoint (reliably, in the shared
    checkpoint folder) so every later use sees the same tags even if an
    executor is lost and partitions are recomputed."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # rows that tie in the order are split by a hash of the row
    order = [F.col(c) for c in order_cols] + [F.xxhash64(*df.columns)]
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    tagged = ranged.withColumns({"_pid": F.spark_partition_id(), "_mono": F.monotonically_increasing_id()})
    return tagged.checkpoint(eager=True)


def consecutive_index(df: DataFrame, order_cols: list[str], index_col: str = "row_index", start: int = 1,
                      num_partitions: int | None = None) -> DataFrame:
    """Gap-free row numbers (start, start+1, ...) in the order of
    ``order_cols``, which should be a total order."""
    tagged = _ranged(df, order_cols, num_partitions)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    # one row per partition: a proven size bound for the broadcast
    local = F.col("_mono") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    out = tagged.join(F.broadcast(offsets), "_pid")
    return out.withColumn(index_col, (F.col("_off") + local + F.lit(start)).cast("bigint")) \
        .drop("_pid", "_mono", "_off")


def index_within_group(df: DataFrame, group_cols: list[str], order_cols: list[str],
                       index_col: str = "row_index", start: int = 1) -> DataFrame:
    """Row numbers restarting at ``start`` in every group.  A hot group is
    spread over several range partitions instead of one task, and few groups
    are broadcast: joined by a shuffle, a group would be one task again."""
    g = consecutive_index(df, group_cols + order_cols, "_g")
    firsts = measured(g.groupBy(*group_cols).agg(F.min("_g").alias("_first")), "group-firsts")
    out = g.join(guarded_broadcast(firsts), group_cols)
    return out.withColumn(index_col, (F.col("_g") - F.col("_first") + F.lit(start)).cast("bigint")) \
        .drop("_g", "_first")


def round_robin(index_col: str, n: int, start: int = 1) -> F.Column:
    """Slot ``(index - start) mod n`` (0-based) for round-robin assignment."""
    return F.pmod(F.col(index_col) - F.lit(start), F.lit(n))


def surrogate_key(index_col: str, prefix: str, width: int) -> F.Column:
    """'cust_000001'-style keys from a row number."""
    return F.format_string(f"{prefix}%0{width}d", F.col(index_col))


def first_n_shuffled(df: DataFrame, key_cols: list[str], n: int, seed: int = 42) -> DataFrame:
    """The first ``n`` rows of a seeded pseudo-random order (MD5 of the key
    and the seed): a repeatable sample; Spark plans it as a top-k."""
    h = F.md5(F.concat_ws("-", *key_cols, F.lit(seed)))
    return df.orderBy(h, *key_cols).limit(n)


def carry_forward(df: DataFrame, value_col: str, order_cols: list[str], out_col: str,
                  num_partitions: int | None = None) -> DataFrame:
    """For every row, the last non-null ``value_col`` at or before it in the
    global order (``last(x, true) over (order by ...)``).

    Each range partition is filled by a window of its own; rows before the
    partition's first value take the last value of the preceding partitions,
    found from one summary row per partition."""
    tagged = _ranged(df, order_cols, num_partitions)
    within = Window.partitionBy("_pid").orderBy("_mono").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = tagged.withColumn(out_col, F.last(value_col, ignorenulls=True).over(within))
    lasts = tagged.groupBy("_pid").agg(
        F.max_by(F.col(value_col), F.when(F.col(value_col).isNotNull(), F.col("_mono"))).alias("_last"))
    prev = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = lasts.select("_pid", F.last("_last", ignorenulls=True).over(prev).alias("_carry"))
    out = local.join(F.broadcast(carry), "_pid", "left")
    return out.withColumn(out_col, F.coalesce(F.col(out_col), F.col("_carry"))).drop("_pid", "_mono", "_carry")
