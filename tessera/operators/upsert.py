"""Keyed upsert (INSERT ... ON CONFLICT (key) DO UPDATE) without MERGE.

result = latest(batch) UNION ALL (target LEFT ANTI JOIN batch keys)

The anti join needs only the batch's keys; they are broadcast when proven
small (the usual micro-batch case), otherwise both sides shuffle on the key
and AQE splits skewed partitions.  The result is a frame; a table that is to
change in place is upserted by ``tessera.sinks.versioned.upsert``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.dedup import latest_per_key
from tessera.session import guarded_broadcast


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], order_by: list[str] | None = None,
           stamp_col: str | None = None, stamp_value=None) -> DataFrame:
    """Replace all non-key columns of target rows whose key is in the batch;
    insert new keys.  With ``order_by`` the batch is first reduced to its
    latest row per key.  ``stamp_col`` is set to ``stamp_value`` on the
    upserted rows (like a dt_update stamped at write time)."""
    if order_by:
        batch = latest_per_key(batch, keys, order_by)
    if stamp_col is not None:
        batch = batch.withColumn(stamp_col, F.lit(stamp_value) if stamp_value is not None
                                 else F.unix_millis(F.current_timestamp()))
    batch = batch.select(*target.columns)
    kept = target.join(guarded_broadcast(batch.select(*keys).distinct()), keys, "left_anti")
    return kept.unionByName(batch)
