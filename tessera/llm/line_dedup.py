"""Substring dedup by hashing lines, paragraphs or sentences.

Texts are cut into units that tile them; a unit's words are normalised and
hashed, the digests are grouped over the whole corpus, the occurrence that
ranks first (smallest doc_id, then smallest hash of the text, then smallest
offset) stays, and every other
one is removed, with its original offsets kept.  Unit ``all`` hashes
sentences, lines and paragraphs and removes the union of their spans, which
nest; of nested spans the outermost is listed.

The first occurrences come from a two-level aggregation (``min`` of the rank
combines before the shuffle), so a line that a third of all documents share
is one row per task; they are joined back with a join whose skewed
partitions AQE splits.

Defined results: a null text is empty and has no units; units without words
always stay; a null doc_id ranks first; rows that repeat a doc_id and
a text are copies of one document, so what the first one keeps stays in each
of them; rows with one doc_id (or none) and other texts are told apart by a
hash of the text; an empty table gives no rows.  Only
``doc_id`` and ``text`` are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import textnp
from tessera.llm.common import materialize

# Where a text is cut: after these, units tile the text.
CUTS = {
    "line": re.compile(r"(?<=\n)"),
    "paragraph": re.compile(r"(?<=\n\n)(?=[^\n])"),
    "sentence": re.compile(r"(?<=\n)|(?<=[.!?])(?=[\x20\x09])"),
}
_NOT_WORD = re.compile(r"[\W_]+")
MIN_WORDS = 1


def units_of(text: str, unit: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, normalised words) of each unit, in code points."""
    at = 0
    for piece in CUTS[unit].split(text):
        if piece:
            yield at, at + len(piece), _NOT_WORD.sub(" ", piece.lower()).strip()
            at += len(piece)


def row_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def nested_units(text: str) -> Iterator[tuple[int, int, str]]:
    """The sentences, lines and paragraphs of a text, as ``units_of`` gives
    them.  A line is left out where only one of its sentences has words, a
    paragraph where only one of its lines has: that unit stands for it."""
    line_at = paragraph_at = end = 0
    line: list[str] = []
    paragraph: list[str] = []

    def close_line() -> Iterator[tuple[int, int, str]]:
        if line:
            words = " ".join(line)
            if len(line) > 1:
                yield line_at, end, words
            paragraph.append(words)
            line.clear()

    def close_paragraph() -> Iterator[tuple[int, int, str]]:
        if len(paragraph) > 1:
            yield paragraph_at, end, " ".join(paragraph)
        paragraph.clear()

    for start, stop, words in units_of(text, "sentence"):
        if start and text[start - 1] == "\n":
            yield from close_line()
            line_at = start
            if text[start] != "\n" and text[start - 2:start] == "\n\n":
                yield from close_paragraph()
                paragraph_at = start
        if words:
            line.append(words)
            yield start, stop, words
        end = stop
    yield from close_line()
    yield from close_paragraph()


def hashed_units(docs: DataFrame, unit: str = "all", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per unit of ``min_words`` words or more: doc_id, row_hash (of
    the text), span (start and end in code points, 32 bits each), digest (128
    bits of the normalised words)."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, list, list, list] = ([], [], [], [])
            for doc_id, text, row_hash in zip(*[c.to_pylist() for c in batch.columns]):
                for start, end, words in nested_units(text or "") if unit == "all" else units_of(text or "", unit):
                    if words and words.count(" ") + 1 >= min_words:
                        digest = hashlib.blake2b(words.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                        for column, value in zip(rows, (doc_id, row_hash, start << 32 | end, digest)):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()),
                                              pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.binary())],
                                             names=["doc_id", "row_hash", "span", "digest"])
    return docs.select("doc_id", "text", row_hash().alias("row_hash")).mapInArrow(
        cut, "doc_id long, row_hash long, span long, digest binary")


def repeated_units(units: DataFrame) -> DataFrame:
    """One row per document that loses units: doc_id, row_hash, starts, ends,
    keep_ids (arrays in ascending order of start)."""
    firsts = (units.groupBy("digest").agg(F.min(F.struct("doc_id", "row_hash", "span")).alias("first"), F.count("*").alias("n"))
              .filter("n > 1").select("digest", "first"))
    repeats = units.join(firsts, "digest").filter(
        ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("row_hash") == F.col("first.row_hash"))
          & (F.col("span") == F.col("first.span"))))
    spans = repeats.groupBy("doc_id", "row_hash").agg(F.array_sort(F.collect_set(
        F.struct(F.shiftright("span", 32).alias("start"), F.col("span").bitwiseAND(F.lit((1 << 32) - 1)).alias("end"),
                 F.col("first.doc_id").alias("keep_id")))).alias("spans"))
    return spans.select("doc_id", "row_hash", *[F.col(f"spans.{c}").alias(f"{c}s") for c in ("start", "end", "keep_id")])


def squeezed(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash, packed (the compressed text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = pa.array([textnp.squeeze((t or "").encode()) for t in batch.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], packed], names=["doc_id", "row_hash", "packed"])
    return docs.select("doc_id", row_hash().alias("row_hash"), "text").mapInArrow(run, "doc_id long, row_hash long, packed binary")


def remove_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, kept_text, n_bytes, n_removed (bytes),
    n_spans (maximal removed runs), spans ("start:end:keep_id" joined by
    commas, code points), kept_sha256."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, packed, starts, ends, keeps in zip(*[c.to_pylist() for c in batch.columns]):
                text = textnp.expand(packed).decode()
                kept, at, runs, last = [], 0, 0, -1
                outer: list[tuple[int, int, int]] = []
                for start, end, keep in sorted(zip(starts or (), ends or (), keeps or ()), key=lambda s: (s[0], -s[1])):
                    if not outer or end > outer[-1][1]:  # spans nest or are apart
                        outer.append((start, end, keep))
                for start, end, _ in outer:
                    kept.append(text[at:start])
                    runs += start != last
                    at = last = end
                kept = "".join(kept) + text[at:]
                raw, whole = kept.encode(), len(text.encode())
                out.append({"doc_id": doc_id, "kept_text": kept, "n_bytes": whole, "n_removed": whole - len(raw),
                            "n_spans": runs, "kept_sha256": hashlib.sha256(raw).hexdigest(),
                            "spans": ",".join(f"{s}:{e}:{k}" for s, e, k in outer)})
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    schema = pa.schema([("doc_id", pa.int64()), ("kept_text", pa.string()), ("n_bytes", pa.int64()),
                        ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
                        ("spans", pa.string())])
    named = spans.withColumnsRenamed({"doc_id": "span_doc_id", "row_hash": "span_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("span_doc_id")) & (F.col("row_hash") == F.col("span_hash"))
    joined = squeezed(docs).join(named, same, "left").select("doc_id", "packed", "starts", "ends", "keep_ids")
    return joined.mapInArrow(cut, "doc_id long, kept_text string, n_bytes long, n_removed long, n_spans long, "
                                  "kept_sha256 string, spans string")


def dedup_units(docs: DataFrame, unit: str = "all", min_words: int = MIN_WORDS) -> DataFrame:
    """Remove every unit that an earlier document, or an earlier place of the
    same one, holds: see ``remove_spans`` for the columns."""
    units = materialize(hashed_units(docs, unit, min_words), "units", {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"})
    return remove_spans(docs, repeated_units(units))
