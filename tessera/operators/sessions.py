"""Gap-based sessionization that stays balanced under key skew.

A session of a user is a maximal run of events whose consecutive gaps are
shorter than ``gap``.  Computing it with ``lag`` over a window partitioned
by user sends every event of a hot user to one task.  Instead:

1. Bucket time into slots of width ``gap``.  Two events in the same slot
   are less than ``gap`` apart, so each (user, slot) is a piece of exactly
   one session; it is summarised as (first, last, count) by a partial
   (map-side) aggregation, which handles any number of rows per user.
2. Only those summaries (at most one per user and slot, bounded by the time
   span, not by the row count) are ordered per user; consecutive pieces
   join the same session when the next first event is less than ``gap``
   after the previous last event.
3. Sessions are the groups of pieces (start, end, events).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F



def session_pieces(df: DataFrame, user_col: str, ts_col: str, gap_seconds: int) -> DataFrame:
    gap_us = int(gap_seconds) * 1_000_000
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                          F.col(ts_col).cast("timestamp_ntz")) \
        if df.schema[ts_col].dataType.simpleString() == "timestamp_ntz" else F.unix_micros(F.col(ts_col))
    return (df.select(F.col(user_col).alias("user_id"), us.alias("_us"))
            .where(F.col("_us").isNotNull())
            .groupBy("user_id", F.floor(F.col("_us") / gap_us).alias("_slot"))
            .agg(F.min("_us").alias("_first"), F.max("_us").alias("_last"),
                 F.count(F.lit(1)).alias("_n")))


def sessions_by_gap(df: DataFrame, user_col: str, ts_col: str, gap_seconds: int) -> DataFrame:
    """(user_id, session_start, session_end, events, duration_seconds);
    start/end are the first and last event times (TIMESTAMP_NTZ)."""
    gap_us = int(gap_seconds) * 1_000_000
    pieces = session_pieces(df, user_col, ts_col, gap_seconds)
    w = Window.partitionBy("user_id").orderBy("_slot")
    prev_last = F.lag("_last").over(w)
    starts = pieces.withColumn(
        "_new", F.when(prev_last.isNull() | (F.col("_first") - prev_last >= gap_us), 1).otherwise(0))
    numbered = starts.withColumn(
        "_sid", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    sess = numbered.groupBy("user_id", "_sid").agg(
        F.min("_first").alias("_start"), F.max("_last").alias("_end"),
        F.sum("_n").cast("bigint").alias("events"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return sess.select(
        "user_id",
        F.timestamp_add("MICROSECOND", F.col("_start"), epoch).alias("session_start"),
        F.timestamp_add("MICROSECOND", F.col("_end"), epoch).alias("session_end"),
        "events",
        F.floor((F.col("_end") - F.col("_start")) / 1_000_000).cast("bigint").alias("duration_seconds"),
    )
