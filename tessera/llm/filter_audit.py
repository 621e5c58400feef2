"""Interactions of filters over all their orders, by difference arrays over
Lehmer ranks.

A document is its mask: the set of filters it fails.  In an order it is
removed at the first step whose filter is in the mask, so the orders in which
a mask goes at step k are those that begin with one of certain prefixes of k
letters, and a prefix covers one interval of lexicographic ranks: it starts
at the prefix's Lehmer code in factorials and is (n - k)! long.  ``intervals``
derives them by rule.  Per part, each mask's counts are added at interval
starts and taken off at interval ends, a running sum over the 120 ranks gives
what each step removes, and the other figures follow from it and the counts
per mask.  Documents are touched once, to find the mask; all later tables
have at most 600 rows per part.

Filters (``failures``): A under 50 words, B few distinct words, C many
capitals, D a sign of ``#$%&*|``, E the text of a smaller doc_id.

Defined results: a null or empty text has no words and no characters, so it
fails A only (and E as any repeated text); a null source is the part ''; a
null doc_id is neither smaller nor larger than another, so it never fails E
and has no labels; rows that repeat both doc_id and text stand alike (neither
has a smaller id); of several labels of a doc_id one positive is enough; an
empty table gives no rows.  Only doc_id, text and source are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, materialize

FILTERS = "ABCDE"
GRID = -1  # stands for a mask that touches every cell and counts nothing


def failures(text: Column) -> dict[str, Column]:
    """The conditions that need the text alone."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.size(words)
    return {"A": n < 50, "B": 100 * F.size(F.array_distinct(words)) < 65 * n,
            "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.length(text), "D": text.rlike("[#$%&*|]")}


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents per part and set of failed
    filters (bit k: the k-th of ``FILTERS``)."""
    text = F.coalesce("text", F.lit(""))
    mask = sum((F.when(c, 1 << FILTERS.index(k)).otherwise(0) for k, c in failures(text).items()), F.lit(0))
    flags = materialize(docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"),
                                    mask.alias("mask")), "filter_masks")
    known = flags.where("doc_id is not null")
    # A hot text spreads over its doc_ids: the least one alone has a partner.
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        *(F.max((F.col(c) == 1).cast("int")).alias(m) for c, m in (("quality", "good"), ("toxic", "toxic"))))
    late = 1 << FILTERS.index("E")
    known = (known.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
             .select("part", (F.col("mask") + F.when(F.col("first"), 0).otherwise(late)).alias("mask"), "good", "toxic"))
    nobody = flags.where("doc_id is null").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return known.union(nobody).groupBy("part", "mask").agg(
        F.count("*").alias("n"), *(F.sum(F.coalesce(c, F.lit(0))).cast("bigint").alias(c) for c in ("good", "toxic")))


def intervals(mask: int, n: int) -> Iterator[tuple[int, int, int]]:
    """(step, first rank, end rank) of the orders of ``n`` filters in which a
    document that fails ``mask`` goes at that step."""
    def follow(free: tuple[int, ...], start: int) -> Iterator[tuple[int, int, int]]:
        step, span = n - len(free) + 1, factorial(len(free) - 1) if free else 0
        for code, k in enumerate(free):
            at = start + code * span
            if mask >> k & 1:
                yield step, at, at + span
            else:
                yield from follow(free[:code] + free[code + 1:], at)
    yield from follow(tuple(range(n)), 0)


def differences(n: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, rank, +1 or -1): interval bounds of every mask, those of
    adjoining intervals left out, and the cells of ``GRID``."""
    out = [(GRID, step, rank, 0) for step in range(1, n + 1) for rank in range(factorial(n))]
    for mask in range(1 << n):
        bounds: dict[tuple[int, int], int] = {}
        for step, at, end in intervals(mask, n):
            bounds[step, at] = bounds.get((step, at), 0) + 1
            bounds[step, end] = bounds.get((step, end), 0) - 1
        out += [(mask, step, rank, sign) for (step, rank), sign in bounds.items() if sign and rank < factorial(n)]
    return out


def interactions(spark: SparkSession, counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step from ``counts`` (part, mask, n, good,
    toxic).  The tables made here depend on the number of filters alone."""
    n = len(filters)
    bounds = spark.createDataFrame(differences(n), "mask int, step int, rank int, sign int")
    orders = ["".join(p) for p in permutations(sorted(filters))]
    names = spark.createDataFrame([(r, k, order, order[k - 1]) for r, order in enumerate(orders) for k in range(1, n + 1)],
                                  "rank int, step int, filter_order string, letter string")
    has = [F.sum(F.when(F.col("mask").bitwiseAND(1 << k) != 0, F.col("n")).otherwise(0)) for k in range(n)]
    only = [F.sum(F.when(F.col("mask") == 1 << k, F.col("n")).otherwise(0)) for k in range(n)]
    parts = counts.groupBy("part").agg(F.sum("n").alias("total"), F.create_map(*(x for k, c in zip(filters, has) for x in (F.lit(k), c))).alias("has"),
                                       F.create_map(*(x for k, c in zip(filters, only) for x in (F.lit(k), c))).alias("only"))
    zero = F.lit(0).cast("bigint")
    cells = counts.union(parts.select("part", F.lit(GRID), zero, zero, zero))
    along = Window.partitionBy("part", "step").orderBy("rank")
    deltas = (cells.join(F.broadcast(bounds), "mask").repartition("part").groupBy("part", "step", "rank")
              .agg(*(F.sum(F.col(c) * F.col("sign")).alias(c) for c in ("n", "good", "toxic"))))
    gone = deltas.select("part", "step", "rank", *(F.sum(c).over(along).alias(m) for c, m in (("n", "removed"), ("good", "good_lost"), ("toxic", "toxic_lost"))))
    down = Window.partitionBy("part", "rank").orderBy("step")
    share = Window.partitionBy("part", "letter")
    return (gone.join(F.broadcast(names), ["rank", "step"])
            .withColumns({"away": F.sum("removed").over(down), "shapley": F.sum("removed").over(share)})
            .join(parts, "part")
            .select("part", "filter_order", "step", (F.col("total") - F.col("away")).alias("kept"), "removed",
                    (F.col("has")[F.col("letter")] - F.col("removed")).alias("redundant"),
                    F.col("only")[F.col("letter")].alias("unique_fails"), "good_lost", "toxic_lost", "shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley."""
    return interactions(docs.sparkSession, materialize(masks(docs, labels), "mask_counts"))
