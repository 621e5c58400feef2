"""Benchmark decontamination by templates.

Texts are reduced to templates: numbers, units after a number and names
(capitalised words within a sentence) become typed placeholders, all other
words are lower-cased literals, punctuation goes.  Windows of ``WINDOW``
template words of the benchmark are hash-joined with all windows of all
documents.  The windows that match are lined up by their distance in the
item and in the document; along each line the placeholders' values must map
consistently (one value of the item always to the same value of the
document), so a re-parameterised question counts and a chance agreement of
placeholders doesn't.  Of a line that is not consistent, the windows whose
words all keep their own value (verbatim) still count.  A document holds an
item when consistent lines cover ``COVERAGE`` of the item's words, or they
and verbatim windows more than that share, or ``LONG_RUN`` words.

The benchmark is the build side.  It is read in blocks of at most
``BLOCK_WINDOWS`` windows (a checked size bound), each broadcast to the
tasks; a larger benchmark takes more passes over the documents and no other
path.  Documents never leave their partition and no pairs of documents arise.

Windows that are less than half literal, and whole items of fewer than
``MIN_ITEM`` words, match by their words' own values only.

Defined results: a null or empty text holds nothing; items of fewer than
``MIN_EXACT`` words are held only by a text that is nothing else; null items
and items without words match nothing; repeated items and repeated
rows answer each for itself; empty tables match nothing.  Columns of the
documents pass through untouched, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import textnp

WINDOW = 8
MIN_ITEM = 5
MIN_EXACT = 3
COVERAGE = 0.5
LONG_RUN = 20
BLOCK_WINDOWS = 500_000
UNITS = ("mm cm m km in ft yd mi mg g kg lb oz ml l s sec min h hr hrs day days week weeks month months year years "
         "hour hours minute minutes second seconds meter meters metre metres mile miles gram grams kilogram kilograms "
         "pound pounds liter liters litre litres dollar dollars euro euros cent cents percent degree degrees "
         "usd eur gbp c f k w kw v hz").split()

_B = np.arange(256)
_UPPER, _LOWER, _DIGIT = (_B >= 65) & (_B <= 90), (_B >= 97) & (_B <= 122), (_B >= 48) & (_B <= 57)
_IN_WORD = _UPPER | _LOWER | _DIGIT | (_B >= 128)
_POINT = (_B == 44) | (_B == 46)
_STOP = np.isin(_B, list(b".!?\n"))
_CODES = textnp.word_codes(True, _IN_WORD | _POINT)
LITERAL, NUMBER, UNIT, NAME = 0, 1, 2, 3
_PLACEHOLDERS = textnp.constants(4, 99)


def _hash_of(words: list[str]) -> np.ndarray:
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends = textnp.runs(_IN_WORD[raw], np.array([0, len(raw)]))
    return textnp.span_hashes(raw, starts, ends, _CODES * _IN_WORD)


_UNIT_HASHES = np.sort(_hash_of(UNITS))


class Templates:
    """Template words of a chunk of texts: ``words`` (hash, placeholders
    replaced), ``values`` (hash of the word itself), ``kind``, and
    ``first`` (each text's first word)."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        inside = _IN_WORD[data]
        if len(data) > 2:  # a point or comma between digits belongs to the number
            digit = _DIGIT[data]
            inner = np.zeros(len(data), bool)
            inner[1:-1] = _POINT[data[1:-1]] & digit[:-2] & digit[2:]
            edge = off[(off > 0) & (off < len(data))]
            inner[edge] = False
            inner[edge - 1] = False
            inside = inside | inner
        starts, ends = textnp.runs(inside, off)
        value_codes = np.where(inside, _CODES[data], np.uint64(0))
        self.values = textnp.value_hashes(value_codes, starts, ends)
        self.first = np.searchsorted(starts, off)
        kind = np.zeros(len(starts), np.uint8)
        if len(starts):
            letters = np.append(0, np.cumsum((_UPPER | _LOWER | (_B >= 128))[data]))
            number = letters[ends] == letters[starts]
            kind[number] = NUMBER
            lead = np.zeros(len(starts), bool)  # a text's first word
            lead[self.first[:-1][self.first[:-1] < len(starts)]] = True
            after = np.zeros(len(starts), bool)
            after[1:] = number[:-1] & ~lead[1:]
            maybe = np.flatnonzero(after & ~number)
            kind[maybe[np.isin(self.values[maybe], _UNIT_HASHES)]] = UNIT
            second = np.minimum(starts + 1, len(data) - 1)
            capital = _UPPER[data[starts]] & (ends - starts > 1) & (_LOWER | (_B >= 128))[data[second]]
            stops = np.append(0, np.cumsum(_STOP[data]))
            opens = lead.copy()
            opens[1:] |= stops[starts[1:]] > stops[ends[:-1]]
            kind[capital & ~opens & (kind == LITERAL)] = NAME
        self.kind = kind
        self.words = np.where(kind == LITERAL, self.values, _PLACEHOLDERS[kind])
        self.literals = np.append(0, np.cumsum(kind == LITERAL))

    def windows(self, n: int, exact: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash of the window at each word, of the words' own values if
        ``exact``; whether it is within a text; whether at least half is
        literal)."""
        hashes = textnp.window_hashes(self.values if exact else self.words, n, 400 + n)
        inside = np.ones(len(hashes), bool)
        for end in self.first[1:]:
            inside[max(0, end - n + 1):end] = False
        literal = 2 * (self.literals[n:] - self.literals[:-n]) >= n if len(hashes) else inside
        return hashes, inside, literal


class Index:
    """Windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = np.array([i for i, _ in items], np.int64)
        data, off = textnp.column_bytes(pa.array([t for _, t in items], pa.string()))
        t = Templates(data, off)
        self.values, self.kind, self.first = t.values, t.kind, t.first
        lengths = np.diff(t.first)
        owner = np.repeat(np.arange(len(items)), lengths)
        self.by_length: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n, exact in [(n, e) for n in range(1, WINDOW + 1) for e in (False, True)]:
            hashes, inside, literal = t.windows(n, exact)
            own = lengths[owner[:len(hashes)]]
            by_template = literal & (n >= MIN_ITEM)
            at = np.flatnonzero(inside & (by_template != exact) & (own >= WINDOW if n == WINDOW else own == n))
            if len(at):
                order = np.argsort(hashes[at], kind="stable")
                seen = np.zeros(1 << 20, bool)
                seen[(hashes[at] & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
                self.by_length[n, exact] = (hashes[at][order], at[order], seen)
        self.owner = owner


def matches(index: Index, data: np.ndarray, off: np.ndarray) -> dict[int, list[tuple[int, int, bool]]]:
    """row -> (item_id, item words covered, re-parameterised) of held items."""
    t = Templates(data, off)
    hits: dict[int, list] = defaultdict(list)
    lengths = np.diff(t.first)
    for (n, exact), (keys, places, seen) in index.by_length.items():
        hashes, good, literal = t.windows(n, exact)
        if not exact:
            good &= literal
        elif n < MIN_EXACT:
            good &= np.repeat(lengths == n, lengths)[:len(good)]
        at = np.flatnonzero(good & seen[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        lo, hi = np.searchsorted(keys, hashes[at]), np.searchsorted(keys, hashes[at], side="right")
        for p, a, b in zip(at[hi > lo], lo[hi > lo], hi[hi > lo]):
            row = int(np.searchsorted(t.first, p, side="right")) - 1
            hits[row].extend((int(q), int(p), n) for q in places[a:b])
    out = {}
    for row, found in hits.items():
        lines: dict[tuple[int, int], list] = defaultdict(list)
        for q, p, n in found:
            lines[int(index.owner[q]), p - q].append((q, n))
        covered: dict[int, set] = defaultdict(set)
        verbatim: dict[int, set] = defaultdict(set)  # of lines that are not consistent
        changed: dict[int, bool] = defaultdict(bool)
        for (item, shift), spans in lines.items():
            words = {q + k for q, n in spans for k in range(n)}
            slots = [w for w in words if index.kind[w]]
            mapped = {(index.kind[w], index.values[w], t.values[w + shift]) for w in slots}
            if len(mapped) == len({m[:2] for m in mapped}):  # one value, one value
                covered[item] |= words
                changed[item] |= any(a != b for _, a, b in mapped)
            else:
                moved = {w for w in slots if index.values[w] != t.values[w + shift]}
                verbatim[item] |= {w for q, n in spans if moved.isdisjoint(range(q, q + n)) for w in range(q, q + n)}
        held = []
        for item in covered.keys() | verbatim.keys():
            length = int(index.first[item + 1] - index.first[item])
            words = covered[item] | verbatim[item]
            if (len(covered[item]) >= min(LONG_RUN, COVERAGE * length) or len(words) >= LONG_RUN
                    or len(words) > COVERAGE * length):
                held.append((int(index.ids[item]), len(words), changed[item]))
        if held:
            out[row] = sorted(held)
    return out


def blocks(benchmark: DataFrame) -> Iterator[Index]:
    """The benchmark as indexes of bounded size."""
    items: list[tuple[int, str]] = []
    windows = 0
    for row in benchmark.select("item_id", "text").filter("item_id is not null and text is not null").toLocalIterator():
        items.append((row.item_id, row.text))
        windows += 1 + len(row.text) // 2
        if windows >= BLOCK_WINDOWS:
            yield Index(items)
            items, windows = [], 0
    if items:
        yield Index(items)


def _rows_with(index: Index, column: pa.Array) -> dict[int, list[tuple[int, int, bool]]]:
    data, off = textnp.column_bytes(column)
    found = {}
    for a, _, d, o in textnp.chunks(data, off):
        found.update({a + row: held for row, held in matches(index, d, o).items()})
    return found


def held_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item it holds: doc_id, row_hash, item_id,
    n_words (of the item, covered), reparameterised."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row_hash", F.xxhash64("text"))
    out = spark.createDataFrame([], "doc_id long, row_hash long, item_id long, n_words long, reparameterised boolean")
    for index in blocks(benchmark):
        shared = spark.sparkContext.broadcast(index)  # at most BLOCK_WINDOWS windows

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(row, *held) for row, items in _rows_with(shared.value, batch.column(1)).items() for held in items]
                at = pa.array([f[0] for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(2).take(at), pa.array([f[1] for f in found], pa.int64()),
                     pa.array([f[2] for f in found], pa.int64()), pa.array([f[3] for f in found], pa.bool_())],
                    names=["doc_id", "row_hash", "item_id", "n_words", "reparameterised"])
        out = out.unionByName(rows.mapInArrow(find, out.schema))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, kept (holds no item), n_items, item_ids
    (ascending), n_words (most of one item), reparameterised."""
    per_doc = held_items(docs, benchmark).groupBy(F.col("doc_id").alias("held_id"), F.col("row_hash").alias("held_hash")).agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("n_words").alias("n_words"),
        F.max("reparameterised").alias("reparameterised"))
    rows = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("row_hash"))
    joined = rows.join(per_doc, F.col("doc_id").eqNullSafe(F.col("held_id")) & (F.col("row_hash") == F.col("held_hash")), "left")
    ids = F.coalesce("item_ids", F.array().cast("array<long>"))
    return joined.select("doc_id", (F.size(ids) == 0).alias("kept"),
                         F.size(ids).cast("bigint").alias("n_items"), ids.alias("item_ids"),
                         F.coalesce("n_words", F.lit(0)).alias("n_words"),
                         F.coalesce("reparameterised", F.lit(False)).alias("reparameterised"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with docs' columns."""
    spark, at = docs.sparkSession, docs.columns.index("text")
    for index in blocks(benchmark):
        shared = spark.sparkContext.broadcast(index)

        def drop(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[list(_rows_with(shared.value, batch.column(at)))] = False
                yield batch.filter(pa.array(keep))
        docs = docs.mapInArrow(drop, docs.schema)
    return docs
