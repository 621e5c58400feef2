"""Helpers shared by the operators: table reading, lineage cuts, word
definitions, and row identity for frames with null or repeated ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

# Words are maximal runs of anything but the six ASCII white-space codes.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: a
    lineage cut that survives lost executors.  ``options`` are the writer's."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    """Number of words of a text (null: 0), without building them."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def size_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none)."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def blocks_for(n_rows: int, rows_per_block: int) -> int:
    """How many hash blocks keep each near ``rows_per_block`` rows."""
    return max(1, -(-int(n_rows) // rows_per_block))
