"""Training-corpus pipeline: five stages over ``documents``, each an operator
of ``tessera.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's result as Parquet under the shared checkpoint folder and reads
it back as the next one's ``docs``.  All stages but the last return docs'
columns.

quality        documents that the Bradley-Terry classifier rejects go
near_dedup     one document of each near-duplicate component stays
decontaminate  documents that hold a benchmark item go
mix            documents come as often as the source mix takes them (0 to 2)
shard          every row gets a shard of 16 and a slot

Null and empty texts: scored by the classifier like any other, link with
nothing, hold nothing, take no part in the mix (no words).  Empty tables give
empty results; repeated rows are one document after ``near_dedup``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate as leaks
from tessera.llm import kd_shards, minhash_dedup, mixing
from tessera.llm import quality as ranking
from tessera.llm.common import materialize, read_table
from tessera.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ranking.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return leaks.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply_copies(docs, mixing.mix(docs))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kd_shards.place(docs, 16)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]

# A trained classifier isn't SQL; tests/llm holds each stage against a plain
# form of its rule on the rows that the stage before it left.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
