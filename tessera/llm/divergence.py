"""How far the sources of a language lie apart, by cells of term counts.

Terms are counted within tasks and summed by Spark; a language keeps the
terms of at least ``MIN_DOCS`` of its documents.  A group (language, source)
gives a term of count c the smoothed share
p = 1 + floor(10^9 (c + 2) / (N + 2 V)), its language likewise, and two
shares differ by f = floor((p - q)^2 / (p + q)), all in exact integers
(decimals where a product can leave 64 bits).

``top_terms`` works on cells: terms of a group with the same counts in group
and language have the same f, so f is evaluated once per cell.  Cells of
equal values are merged, values are ranked by their cumulative multiplicity,
and only cells that reach the first ranks are expanded to terms, in UTF-8
order.  ``source_pairs`` sums f over the kept terms for each two sources.  A
term travels as one row (its counts by source); tasks add tiles of 64 x 64
sources and emit one partial sum per pair, so no row is made per term and
pair.  The result itself has a row for each two sources of a language.

Defined results: null text, lang and source are read as ''; each row counts
as a document, whatever its doc_id; a group without terms takes part with
counts of 0; a language that keeps no term gives pairs of value 0 and no
terms; an empty table gives no rows.  Only text, lang and source are read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize

MIN_DOCS = 10
UNIT = 1_000_000_000
RANKS = 10
TASK_TERMS = 400_000   # distinct (group, term) a task holds before it hands them on
TILE = 64
TILE_CELLS = 4 << 20   # numbers a task works on at once
HELD_CELLS = 8 << 20   # sums a task holds before it hands them on

# Lower-cased ASCII letters and every byte of a code point above ASCII.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
NO_TERM = ""  # a row that stands for the group itself


def count_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: occurrences and documents of each term,
    and a row of ``NO_TERM`` for each group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

        def hand_on() -> pa.RecordBatch:
            columns: list[list] = [[], [], [], [], []]
            for (lang, source), (n, of_docs) in held.items():
                columns[0] += [lang] * (len(n) + 1)
                columns[1] += [source] * (len(n) + 1)
                columns[2] += [b"", *n]
                columns[3] += [0, *n.values()]
                columns[4] += [0, *map(of_docs.__getitem__, n)]
            held.clear()
            types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang, source, text in zip(langs, sources, batch.column(2)):
                terms = _TERM.findall(text.as_buffer().to_pybytes().lower())
                n, of_docs = held[lang, source]
                n.update(terms)
                of_docs.update(set(terms))
            if sum(len(n) for n, _ in held.values()) > TASK_TERMS:
                yield hand_on()
        if held:
            yield hand_on()

    texts = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counted = texts.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, term, n, lang_n, lead: kept terms of each group with
    their counts in group and language (``lead``: the term's first source),
    and the rows of ``NO_TERM``."""
    term = Window.partitionBy("lang", "term")
    return (count_terms(docs)
            .select("lang", "source", "term", "n", F.sum("n").over(term).alias("lang_n"), F.sum("docs").over(term).alias("in_docs"),
                    (F.col("source") == F.min("source").over(term)).alias("lead"))
            .where((F.col("in_docs") >= min_docs) | (F.col("term") == NO_TERM)).drop("in_docs"))


def share(n: str, total: str) -> Column:
    """1 + floor(UNIT (n + 2) / (total + 2 terms)), exact at any count."""
    return F.expr(f"1 + (cast({UNIT} as decimal(18, 0)) * cast({n} + 2 as decimal(20, 0))) div cast({total} + 2 * terms as decimal(20, 0))")


def groups_of(kept: DataFrame) -> DataFrame:
    """lang, source, place (of the source in its language), total,
    lang_total, terms."""
    lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"),
                                    F.sum((F.col("lead") & (F.col("term") != NO_TERM)).cast("bigint")).alias("terms"))
    group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return group.withColumn("place", place).join(lang, "lang")


def top_terms(kept: DataFrame, groups: DataFrame, ranks: int = RANKS) -> DataFrame:
    """lang, source, item, value, rank of the terms a group has most in
    excess of its language."""
    group, value = ["lang", "source"], [*("lang", "source"), "value"]
    terms = kept.where(F.col("term") != NO_TERM)
    cells = (terms.where("n > 0").groupBy(*group, "n", "lang_n").agg(F.count("*").alias("many")).join(groups, group)
             .withColumns({"p": share("n", "total"), "q": share("lang_n", "lang_total")}).where("p > q")
             .select(*group, "n", "lang_n", "many", F.expr("((p - q) * (p - q)) div (p + q)").alias("value")))
    down = Window.partitionBy(*group).orderBy(F.desc("value"))
    before = F.coalesce(F.sum("many").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # each value stands for a term at least, so later values can't reach the ranks
    values = (cells.groupBy(*value).agg(F.sum("many").alias("many"))
              .withColumn("at", F.row_number().over(down)).where(F.col("at") <= ranks)
              .withColumn("before", before).where(F.col("before") < ranks).select(*value, "before"))
    chosen = cells.join(values, value).select(*group, "n", "lang_n", "value", "before")
    within = F.row_number().over(Window.partitionBy(*value).orderBy("term"))
    return (terms.join(chosen, [*group, "n", "lang_n"]).withColumn("within", within).where(F.col("within") <= ranks)
            .withColumn("rank", (F.col("before") + F.col("within")).cast("int")).where(F.col("rank") <= ranks)
            .select(*group, F.col("term").alias("item"), "value", "rank"))


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value, rank: every other source of the language by
    how far it lies off, the farthest first."""
    sized = groups.select("lang", "source", "place", "total", "terms")
    shared = kept.join(sized, ["lang", "source"]).select(
        "lang", "term", F.struct("place", F.when(F.col("terms") > 0, share("n", "total")).otherwise(1).alias("p")).alias("at"))
    vectors = shared.groupBy("lang", "term").agg(F.collect_list("at").alias("at"))
    # the shares of a count of 0, one per source, and a language's row of
    # NO_TERM, which gives its pairs a sum of 0 to begin with
    floor = (groups.select("lang", F.struct("place", F.when(F.col("terms") > 0, share("0", "total")).otherwise(1).alias("p")).alias("zero"))
             .groupBy("lang").agg(F.transform(F.sort_array(F.collect_list("zero")), lambda z: z["p"]).alias("zeros")))
    rows = vectors.join(floor, "lang").select("lang", (F.col("term") == NO_TERM).alias("none"), "at.place", "at.p", "zeros")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}

        def hand_on() -> Iterator[pa.RecordBatch]:
            for (lang, a, b), tile in sums.items():
                i, j = np.nonzero(np.add.outer(np.arange(tile.shape[0]) + a, -(np.arange(tile.shape[1]) + b)) < 0)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(i), pa.string()), pa.array(i + a, pa.int32()), pa.array(j + b, pa.int32()),
                                                  pa.array(tile[i, j])], names=["lang", "a", "b", "value"])
            sums.clear()

        def add(lang: str, shares: np.ndarray) -> Iterator[pa.RecordBatch]:
            size = shares.shape[1]
            for a in range(0, size, TILE):
                for b in range(a, size, TILE):
                    p, q = shares[:, a:a + TILE, None], shares[:, None, b:b + TILE]
                    key, step = (lang, a, b), max(1, TILE_CELLS // (TILE * TILE))
                    if key not in sums:
                        sums[key] = np.zeros((p.shape[1], q.shape[2]), np.int64)
                    for k in range(0, len(shares), step):
                        apart = p[k:k + step] - q[k:k + step]
                        sums[key] += (apart * apart // (p[k:k + step] + q[k:k + step])).sum(axis=0)
                    if len(sums) * TILE * TILE > HELD_CELLS:
                        yield from hand_on()

        for batch in batches:
            langs, none = np.array(batch.column(0).to_pylist(), object), np.asarray(batch.column(1).to_pylist(), bool)
            place, p, zeros = batch.column(2), batch.column(3), batch.column(4)
            for lang in sorted(set(langs.tolist())):
                mine = np.flatnonzero(langs == lang)
                zero = np.asarray(zeros[int(mine[0])].values, np.int64)
                if none[mine].any():
                    yield from add(lang, np.zeros((0, len(zero)), np.int64))
                terms, step = mine[~none[mine]], max(1, TILE_CELLS // len(zero))
                for k in range(0, len(terms), step):
                    shares = np.repeat(zero[None, :], len(terms[k:k + step]), axis=0)
                    for row, at in enumerate(terms[k:k + step].tolist()):
                        shares[row, np.asarray(place[at].values)] = np.asarray(p[at].values)
                    yield from add(lang, shares)
        yield from hand_on()

    sums = rows.mapInArrow(run, "lang string, a int, b int, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.select("lang", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("ab"), "value")
    named = lambda at, name: groups.select("lang", F.col("place").alias(at), F.col("source").alias(name))
    out = (both.select("lang", F.col("ab.a").alias("a"), F.col("ab.b").alias("b"), "value")
           .join(named("a", "source"), ["lang", "a"]).join(named("b", "item"), ["lang", "b"]))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return out.select("lang", "source", "item", "value", rank.alias("rank"))


def audit(docs: DataFrame) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    kept = materialize(kept_counts(docs), "kept_terms")
    groups = materialize(groups_of(kept), "source_groups")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (source_pairs(kept, groups).withColumn("part", F.lit("pair")).select(columns)
            .union(top_terms(kept, groups).withColumn("part", F.lit("term")).select(columns)))
