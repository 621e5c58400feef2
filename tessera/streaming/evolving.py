"""Streaming load of landed JSON whose columns grow.

Lines are streamed as text, so the stream's own schema never changes.  Each
micro-batch finds the fields of its own lines (one aggregation), widens the
table's stored schema by the new ones, parses with the wider schema and
commits rows, schema and batch number as one version of the target
(``tessera.sinks.versioned``).  A repeated batch does nothing; a restarted
stream goes on from the schema that the last version holds.  Rows that came
before a column have NULL in it.

A column keeps the type of its first sight (or of the schema given at the
start).  A line that doesn't parse, or whose value doesn't fit its column,
keeps its whole text in ``_rescued`` beside what could be parsed: nothing
becomes NULL without trace.

Lineage per row: ``_source_file``, ``_ingested_at``, ``_kafka_topic`` (the
folder below the landing) and ``_blob_partition_hour`` (``yyyy-MM-dd HH`` of
the year=/month=/day=/hour= folders; NULL outside such).  The target is sliced
by the day of that hour.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sinks import versioned
from tessera.sinks.files import TIMESTAMP_OPTIONS

RESCUED = "_rescued"
LINEAGE = ["_source_file", "_ingested_at", "_kafka_topic", "_blob_partition_hour"]
_HOUR_PATH = r"/year=(\d+)/month=(\d+)/day=(\d+)/hour=(\d+)/"


def found_fields(lines: DataFrame, value_col: str = "value") -> T.StructType:
    """The top-level fields of JSON lines with their types, from the lines
    themselves.  Whole numbers are BIGINT, other numbers decimals with room
    for later ones (DOUBLE for exponents); fields of mixed kinds are text;
    fields that only ever are null are left out, as nothing is known of them."""
    text = lines.agg(F.schema_of_variant_agg(F.try_parse_json(value_col)).alias("s")).first().s
    if text is None or not text.startswith("OBJECT<"):
        return T.StructType([])
    # the functions name objects OBJECT and fields of mixed kinds VARIANT
    fields = T._parse_datatype_string(re.sub(r"\bOBJECT<", "STRUCT<", re.sub(r"\bVARIANT\b", "STRING", text)))
    return T.StructType([T.StructField(f.name, _roomy(f.dataType)) for f in fields if not _unknown(f.dataType)])


def _roomy(kind: T.DataType) -> T.DataType:
    return T.DecimalType(38, max(10, kind.scale)) if isinstance(kind, T.DecimalType) else kind


def _unknown(kind: T.DataType) -> bool:
    """Whether a type holds a part that no line shows a value of."""
    if isinstance(kind, T.ArrayType):
        return _unknown(kind.elementType)
    if isinstance(kind, T.StructType):
        return not kind.fields or any(_unknown(f.dataType) for f in kind.fields)
    return isinstance(kind, T.NullType)


def lineage(path: Column, landing: str) -> dict[str, Column]:
    hour = [F.regexp_extract(path, _HOUR_PATH, k) for k in range(1, 5)]
    name = landing.rstrip("/").rsplit("/", 1)[-1]
    return {"_source_file": path, "_ingested_at": F.current_timestamp(),
            "_kafka_topic": F.regexp_extract(path, f"/{re.escape(name)}/([^/]+)/", 1),
            "_blob_partition_hour": F.when(hour[0] != "", F.format_string("%s-%s-%s %s", *hour))}


def parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Lines by ``schema``, with ``RESCUED`` and the lines' other columns."""
    full = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])
    row = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUED} | TIMESTAMP_OPTIONS)
    # a generator column, so that the parse isn't repeated per field
    return lines.withColumn("_row", F.explode(F.array(row))).select(
        *(F.col("_row")[f.name].alias(f.name) for f in full), *[c for c in lines.columns if c != "value"])


def stored_fields(spark: SparkSession, root: str) -> T.StructType:
    """The data columns that the target's newest version has."""
    schema = versioned.load(spark, root).schema
    fields = T.StructType.fromJson(json.loads(schema)).fields if schema else []
    return T.StructType([f for f in fields if f.name not in (RESCUED, *LINEAGE)])


def evolving_load(spark: SparkSession, landing: str, root: str, checkpoint: str, start: T.StructType | None = None,
                  name: str = "load", max_files_per_trigger: int | None = None):
    """A configured writer that loads ``landing/<topic>/...`` into ``root``;
    start it with ``jobs.run``.  ``start``: columns known beforehand."""
    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        marks = versioned.load(session, root).marks
        if marks.get(name, -1) >= batch_id:
            return
        lines = batch.persist()
        try:
            known = stored_fields(session, root) or T.StructType([])
            known = known if known.fields else (start or T.StructType([]))
            new = [f for f in found_fields(lines) if f.name not in known.names and f.name not in (RESCUED, *LINEAGE)]
            rows = parsed(lines, T.StructType([*known.fields, *new]))
            versioned.append(rows, root, F.substring("_blob_partition_hour", 1, 10), {name: batch_id})
        finally:
            lines.unpersist()

    source = spark.readStream.format("text").schema("value string").option("recursiveFileLookup", "true")  # hours are no columns here
    if max_files_per_trigger:
        source = source.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = source.load(f"{landing.rstrip('/')}/*")
    lines = stream.select("value", *(c.alias(n) for n, c in lineage(F.col("_metadata.file_path"), landing).items()))
    return lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(load)
