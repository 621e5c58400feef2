"""Message-log sources: Kafka when its connector is on the classpath, and a
file-backed topic log with the same record layout (key, value, topic,
partition, offset, timestamp) for batch replays and tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.sequence import index_within_group

RECORD_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp"]


def kafka_available(spark: SparkSession) -> bool:
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(
            "org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:
        return False


def read_kafka(spark: SparkSession, bootstrap: str, topics: str, starting: str = "earliest",
               ending: str = "latest") -> DataFrame:
    """Batch read of Kafka topics (needs the spark-sql-kafka package)."""
    if not kafka_available(spark):
        raise RuntimeError("the Kafka connector is not on the classpath; "
                           "use read_topic_log on a file-backed log instead")
    return (spark.read.format("kafka").option("kafka.bootstrap.servers", bootstrap)
            .option("subscribe", topics).option("startingOffsets", starting)
            .option("endingOffsets", ending).load())


def to_topic_records(df: DataFrame, topic: str, key_cols: list[str], partitions: int,
                     partition_expr: F.Column, order_cols: list[str], ts_col: str | None = None) -> DataFrame:
    """Encode rows as topic records: JSON key and value, the partition from
    ``partition_expr`` (mod ``partitions``) and gap-free offsets per
    partition in the order of ``order_cols`` (computed without sending a
    partition's records to one task).  Rows are numbered before they are
    encoded, so that the sort moves columns and not their text."""
    dealt = df.withColumn("_partition", F.pmod(partition_expr, F.lit(partitions)).cast("int"))
    numbered = index_within_group(dealt, ["_partition"], order_cols, "_offset", start=0)
    return numbered.select(
        F.to_json(F.struct(*key_cols)).cast("binary").alias("key"),
        F.to_json(F.struct(*df.columns)).cast("binary").alias("value"),
        F.lit(topic).alias("topic"), F.col("_partition").alias("partition"), F.col("_offset").alias("offset"),
        F.timestamp_millis(F.col(ts_col) if ts_col else F.lit(None).cast("bigint")).alias("timestamp"))


def read_topic_log(spark: SparkSession, path: str, topics: list[str] | None = None) -> DataFrame:
    """A topic log stored as Parquet, with Kafka's record columns."""
    log = spark.read.parquet(path)
    return log.where(F.col("topic").isin(*topics)) if topics else log


def decode_values(records: DataFrame, schema) -> DataFrame:
    """CAST(value AS STRING) -> typed columns, keeping partition/offset."""
    return records.select(F.from_json(F.col("value").cast("string"), schema).alias("r"),
                          "topic", "partition", "offset").select("r.*", "topic", "partition", "offset")
