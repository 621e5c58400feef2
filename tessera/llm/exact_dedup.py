"""Exact dedup against a minimal perfect hash of historical digests.

``build_index`` keeps the distinct digests of the historical rows in a
minimal perfect hash: one slot per digest, holding the full digest, the
winner's doc_id as locator and the number of rows.  Digests are spread over
hash buckets of bounded size, and each bucket gets its own function (hash
and displace: a pilot per small group of keys, placed largest group first).
``look_up`` evaluates the function for distinct new digests; a digest that
its slot does not hold is no member.  Members are repeats; nonmembers group
among themselves.  Repeats are compared with the winner's text byte by byte.

Skew: rows are pre-aggregated to distinct digests (map-side combine) before
anything is gathered by bucket, so a text that a third of all rows share is
one entry; the answer is joined back with a join whose skewed partitions AQE
splits.

Defined results: a null text is empty; of equal texts the largest doc_id
wins, nulls last; rows repeating the winner's doc_id are all kept; an empty
table gives no rows.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import blocks_for, materialize
from tessera.llm.textnp import mix64

KEYS_PER_BUCKET = 20_000
KEYS_PER_PILOT = 4

INDEX = "bucket int, slot int, digest binary, winner long, n_rows long, pilot int"
_U = np.uint64


def _halves(digests: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"".join(digests), np.uint64).reshape(len(digests), -1)
    return raw[:, 1].copy(), raw[:, 2].copy()


def _slots(spread: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    return (mix64(spread ^ mix64(pilots.astype(np.uint64) + _U(1))) % _U(n)).astype(np.int64)


def _place(digests: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(slot of each key, pilot of each group) of a minimal perfect hash."""
    n = len(digests)
    groups = max(1, n // KEYS_PER_PILOT)
    choose, spread = _halves(digests)
    group = (choose % _U(groups)).astype(np.int64)
    pilots, slots = np.zeros(groups, np.int64), np.empty(n, np.int64)
    order = np.argsort(group, kind="stable")
    sizes = np.bincount(group, minlength=groups)
    ends = np.cumsum(sizes)
    free = np.ones(n, bool)
    tries = np.arange(256)
    for g in np.argsort(-sizes, kind="stable"):
        keys = order[ends[g] - sizes[g]:ends[g]]
        first, found = 0, len(keys) == 0
        while not found:
            at = _slots(spread[keys][:, None], (tries + first)[None, :], n)
            good = free[at].all(axis=0)
            if len(keys) > 1:
                ranked = np.sort(at, axis=0)
                good &= (ranked[1:] != ranked[:-1]).all(axis=0)
            if good.any():
                k = int(np.argmax(good))
                pilots[g], found = first + k, True
                slots[keys] = at[:, k]
                free[at[:, k]] = False
            first += len(tries)
    return slots, pilots


def build_index(history: DataFrame, n_buckets: int) -> DataFrame:
    """Index of distinct historical digests (digest, winner, n_rows): one row
    per slot, with the function's pilots stored on the first slots."""
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("digest", ignore_index=True)
        slots, pilots = _place(rows["digest"])
        out = rows.assign(slot=slots.astype(np.int32)).sort_values("slot", ignore_index=True)
        out["pilot"] = np.append(pilots, np.zeros(len(out) - len(pilots), np.int64)).astype(np.int32)
        return out[["bucket", "slot", "digest", "winner", "n_rows", "pilot"]]
    bucketed = history.select(_bucket(n_buckets).alias("bucket"), "digest", "winner", "n_rows")
    return bucketed.groupBy("bucket").applyInPandas(build, INDEX)


def _bucket(n_buckets: int):
    return F.pmod(F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("bigint"), F.lit(n_buckets)).cast("int")


def look_up(distinct: DataFrame, index: DataFrame, n_buckets: int) -> DataFrame:
    """For each distinct new digest (digest, winner, n_rows): the index's
    winner and row count where the digest is a member, else nulls."""
    def probe(new: pd.DataFrame, slots: pd.DataFrame) -> pd.DataFrame:
        out = new[["digest", "winner", "n_rows"]].assign(old_winner=pd.array([None] * len(new), "Int64"),
                                                         old_rows=pd.array([None] * len(new), "Int64"))
        if len(new) and len(slots):
            slots = slots.sort_values("slot", ignore_index=True)
            n = len(slots)
            choose, spread = _halves(new["digest"])
            group = (choose % _U(max(1, n // KEYS_PER_PILOT))).astype(np.int64)
            at = _slots(spread, slots["pilot"].to_numpy()[group], n)
            hit = slots["digest"].to_numpy()[at] == new["digest"].to_numpy()
            out.loc[hit, "old_winner"] = slots["winner"].to_numpy()[at][hit]
            out.loc[hit, "old_rows"] = slots["n_rows"].to_numpy()[at][hit]
        return out
    bucketed = distinct.select(_bucket(n_buckets).alias("bucket"), "digest", "winner", "n_rows")
    return (bucketed.groupBy("bucket").cogroup(index.groupBy("bucket"))
            .applyInPandas(probe, "digest binary, winner long, n_rows long, old_winner long, old_rows long"))


def dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256,
    in_history (the winner came from the index).

    The history is the upper half of the id range, the new rows the rest, so
    a member's winner is the history's; any split gives the same groups."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
        .withColumn("digest", F.unhex(F.sha2("text", 256)))
    base = texts.select("doc_id", "digest")
    bounds = docs.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n")).first()
    middle = 0 if bounds.lo is None else bounds.lo + (bounds.hi - bounds.lo) // 2
    n_buckets = blocks_for(bounds.n, KEYS_PER_BUCKET)
    old = F.coalesce(F.col("doc_id") >= F.lit(middle), F.lit(False))
    distinct = materialize(base.groupBy(old.alias("old"), "digest")
                           .agg(F.max("doc_id").alias("winner"), F.count("*").alias("n_rows")), "distinct")
    index = materialize(build_index(distinct.filter("old"), n_buckets), "mphf")
    answers = materialize(look_up(distinct.filter("not old"), index, n_buckets), "answers")
    member = F.col("old_rows").isNotNull()
    # the history's own groups grow by the members found; nonmembers are groups of their own
    repeats = answers.filter(member).select("digest", F.col("n_rows").alias("more"))
    grown = index.join(repeats, "digest", "left").select(
        "digest", "winner", (F.col("n_rows") + F.coalesce("more", F.lit(0))).alias("size"), F.lit(True).alias("in_history"))
    fresh = answers.filter(~member).select("digest", "winner", F.col("n_rows").alias("size"), F.lit(False).alias("in_history"))
    groups = materialize(grown.unionByName(fresh), "groups")
    alone = base.join(groups.filter("size = 1"), "digest")
    return _result(alone).unionByName(_checked(texts, groups.filter("size > 1")))


def _result(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", F.col("winner").alias("keep_id"), F.col("size").alias("group_size"),
                       F.col("doc_id").eqNullSafe(F.col("winner")).alias("kept"),
                       F.lower(F.hex("digest")).alias("text_sha256"), "in_history")


def _checked(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of groups of two or more, each text compared with its winner's.
    If any bytes differ (one digest, different texts), the rows of that
    digest are grouped by their bytes instead."""
    rows = materialize(texts.join(groups, "digest"), "repeats")
    # written first: then the join has two plain inputs, and AQE can split a hot digest
    winners = materialize(rows.filter(F.col("doc_id").eqNullSafe(F.col("winner")))
                          .groupBy("digest").agg(F.min("text").alias("winner_text")), "winners")
    compared = materialize(rows.join(winners, "digest").withColumn("same", F.col("text") == F.col("winner_text"))
                           .drop("text", "winner_text"), "compared")
    differ = compared.filter("not same").select("digest").distinct()
    if differ.isEmpty():
        return _result(compared)
    apart = rows.join(differ, "digest", "left_semi").select("doc_id", "digest", "text", "in_history")
    by_text = apart.groupBy("text").agg(F.max("doc_id").alias("winner"), F.count("*").alias("size"))
    return _result(compared.join(differ, "digest", "left_anti")).unionByName(_result(apart.join(by_text, "text")))
