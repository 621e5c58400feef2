"""Substring dedup over a collection's Burrows-Wheeler transform.

A byte goes when a ``WIDTH``-byte string that covers it also starts in a
document with a smaller doc_id.  The collection index is built column by
column: in each round every text of the collection gets one more symbol, from
its end to its start, and the transform, the suffix positions and the common
prefixes of neighbouring suffixes are rewritten, file by file, from those of
the round before (after Bauer, Cox and Rosone's multi-string construction and
its extension with common prefixes).  Runs of suffixes with common prefixes
of ``WIDTH`` or more are the repeated strings, and each run's least doc_id
decides.

A round costs one pass over everything inserted so far, so texts must be
short and what is compared must meet in one task.  Both come from minimizers:
of each ``WIDTH``-byte string, the least hash of its ``SEED``-byte strings.
Equal strings have equal minimizers, so a text falls into fragments (runs of
strings with one minimizer value, at most ``RUN`` strings each, plus the
bytes that the last one covers), every string lies in exactly one fragment,
and fragments of one minimizer go to one bucket.

1. Copies of a whole text are one entry: its least doc_id keeps the bytes.
2. Minimizers that occur in one document only are dropped.  They travel as
   packed arrays by hash bucket, sorted and scanned there.
3. The remaining fragments travel packed by bucket; equal fragments are one
   text of the collection there, with their least doc_id.
4. Each bucket builds the transform of its collection, less the fragments
   whose bytes around the minimizer no other one has, and reports covered
   ranges.
5. Ranges are united per document and cut from the texts.

Bucket counts follow the input, so buckets stay of bounded size.  What they
find goes packed to blocks of documents, not in a row per document and bucket,
whose number would grow with both.  A fragment
that many documents share is one entry of the collection.  Where a minimizer
occurs more than ``HOT`` times (an edge of a line that very many documents
hold has another fragment in each), its strings travel one by one, dealt by
their own bytes, so no bucket gets them all.

Defined results: a null text has no bytes; texts shorter than ``WIDTH`` lose
nothing; a null doc_id is smaller than all others; rows that repeat a doc_id
never take bytes from each other; an empty table gives no rows.  Only doc_id
and text are read.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import textnp
from tessera.llm.common import blocks_for, materialize

WIDTH = 50
SEED = 16
RUN = 35
PLACES = 7
KEYS_PER_BUCKET = 1_000_000
FRAGMENT_BYTES_PER_BUCKET = 1 << 20
TEXT_BYTES_PER_BLOCK = 32 << 20
HOT = 20_000
NULL_ID = -(1 << 63)

_U = np.uint64
_CODES = textnp.constants(256, 31)
_STRING = textnp.constants(WIDTH, 33)
_STEP = textnp.constants(4, 32) | _U(1)


def seed_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of each SEED-byte string."""
    h = _CODES[data]
    size = 1
    for c in _STEP:  # hashes of 2, 4, 8, 16 bytes
        h = h[:-size] * c + h[size:]
        size *= 2
    return textnp.mix64(h)


def minimizers(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Fragments of a chunk: (row, start within the text, number of WIDTH-byte
    strings, minimizer value)."""
    n = len(data) - WIDTH + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    h = seed_hashes(data)
    span, want = 1, WIDTH - SEED + 1
    while span < want:  # least of ``want`` successive hashes, by doubling
        step = min(span, want - span)
        h = np.minimum(h[:-step], h[step:])
        span += step
    good = np.ones(n, bool)  # strings that stay within their text
    ends = off[1:]
    covered = np.zeros(n + 1, np.int64)
    lo, hi = np.maximum(ends - WIDTH + 1, off[:-1]), ends
    inside = lo < n
    np.add.at(covered, lo[inside], 1)
    np.add.at(covered, np.minimum(hi[inside], n), -1)
    good &= np.cumsum(covered[:-1]) == 0
    change = np.ones(n, bool)
    change[1:] = h[1:] != h[:-1]
    change[off[:-1][off[:-1] < n]] = True
    change[1:] |= good[1:] != good[:-1]
    starts = np.flatnonzero(change)
    lengths = np.diff(np.append(starts, n))
    starts, lengths = starts[good[starts]], lengths[good[starts]]
    pieces = -(-lengths // RUN)  # periodic text has long runs
    if (pieces > 1).any():
        extra = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        base, left = np.repeat(starts, pieces), np.repeat(lengths, pieces)
        starts, lengths = base + extra * RUN, np.minimum(RUN, left - extra * RUN)
    row = np.searchsorted(off, starts, side="right") - 1
    return row, starts - off[row], lengths, h[starts]


def _by_bucket(key: np.ndarray, n_buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, positions) of the buckets that occur, positions ascending."""
    bucket = ((key >> _U(32)) % _U(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        if len(part):
            yield int(bucket[part[0]]), part


def _binary_rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    """A batch of (bucket, bytes, ...) rows."""
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                       *[pa.array([r[k] for r in rows], pa.binary()) for k in range(1, len(names))]], names=names)


def _column(rows: pd.DataFrame, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(map(textnp.expand, rows[name])), kind)


def _pack(columns: list[np.ndarray], at: np.ndarray) -> tuple:
    return tuple(textnp.squeeze(c[at].tobytes()) for c in columns)


def squeezed(texts: DataFrame) -> DataFrame:
    """doc_id, id, row_key, packed (the compressed text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = textnp.column_bytes(batch.column(3))
            packed = pa.array([textnp.squeeze(data[a:b].tobytes()) for a, b in zip(off[:-1], off[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], packed], names=["doc_id", "id", "row_key", "packed"])
    return texts.select("doc_id", "id", "row_key", "text").mapInArrow(run, "doc_id long, id long, row_key long, packed binary")


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return textnp.column_bytes(pa.array([textnp.expand(x) for x in column.to_pylist()], pa.binary()))


def _longs(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def packed_minimizers(texts: DataFrame, n_buckets: int) -> DataFrame:
    """bucket, marks (32 bits of the minimizer; the bucket holds others), ids,
    row_keys, starts: packed arrays of equal length."""
    names = ["bucket", "marks", "ids", "row_keys", "starts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = _longs(batch.column(0)), _longs(batch.column(1))
            data, off = textnp.column_bytes(batch.column(2))
            parts = [(a, minimizers(d, o)) for a, _, d, o in textnp.chunks(data, off)]
            if not parts:
                continue
            row = np.concatenate([a + p[0] for a, p in parts])
            start = np.concatenate([p[1] for _, p in parts]).astype(np.int32)
            value = np.concatenate([p[3] for _, p in parts])
            mark = value.astype(np.uint32)
            columns = [mark, ids[row], keys[row], start]
            yield _binary_rows([(b, *_pack(columns, at)) for b, at in _by_bucket(value, n_buckets)], names)
    return texts.select("id", "row_key", "text").mapInArrow(
        run, "bucket int, marks binary, ids binary, row_keys binary, starts binary")


def _dealt(ids: np.ndarray, keys: np.ndarray, first: np.ndarray, last: np.ndarray, n_blocks: int) -> pd.DataFrame:
    """Places of documents, packed by block of documents: ``by_document``."""
    rows = [(block, *_pack([ids, keys, first, last], at)) for block, at in _by_bucket(keys.view(np.uint64), n_blocks)]
    return pd.DataFrame(rows, columns=["block", "ids", "row_keys", "firsts", "lasts"])


_DEALT = "block int, ids binary, row_keys binary, firsts binary, lasts binary"


def by_document(dealt: DataFrame) -> DataFrame:
    """One row per document: id, row_key, parts (its distinct pairs of first
    and last, packed in ascending order), n (their number)."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        ids, keys, first, last = (_column(rows, c, kind) for c, kind in (
            ("ids", np.int64), ("row_keys", np.int64), ("firsts", np.int32), ("lasts", np.int32)))
        order = np.lexsort((last, first, keys, ids))
        order = order[[a for a, _ in _runs_of(ids[order], keys[order], first[order], last[order])]]
        parts = _runs_of(ids[order], keys[order])
        heads, pairs = order[[a for a, _ in parts]], np.stack([first[order], last[order]], axis=1)
        return pd.DataFrame({"id": ids[heads], "row_key": keys[heads], "parts": [pairs[a:b].tobytes() for a, b in parts],
                             "n": [b - a for a, b in parts]})
    return dealt.groupBy("block").applyInPandas(run, "id long, row_key long, parts binary, n long")


def shared_starts(packed: DataFrame, n_blocks: int) -> DataFrame:
    """Fragments whose minimizer occurs in two documents or more, as start and
    whether it occurs more than ``HOT`` times, for ``by_document``."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        mark, doc, key, start = (_column(rows, c, kind) for c, kind in (
            ("marks", np.uint32), ("ids", np.int64), ("row_keys", np.int64), ("starts", np.int32)))
        order = np.argsort(mark, kind="stable")
        ranked = mark[order]
        heads = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
        count = np.diff(np.append(heads, len(order)))
        many = np.minimum.reduceat(doc[order], heads) != np.maximum.reduceat(doc[order], heads)
        hot = np.zeros(len(order), np.int32)
        hot[order[np.repeat(many & (count > HOT), count)]] = 1  # to be spread by string instead of by minimizer
        keep = np.sort(order[np.repeat(many, count)])
        return _dealt(doc[keep], key[keep], start[keep], hot[keep], n_blocks)
    return packed.groupBy("bucket").applyInPandas(run, _DEALT)


def _runs_of(*columns: np.ndarray) -> list[tuple[int, int]]:
    """(first, end) of runs of equal rows."""
    n = len(columns[0])
    if n == 0:
        return []
    change = np.zeros(n, bool)
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    cuts = np.flatnonzero(change)
    return list(zip(np.append(0, cuts).tolist(), np.append(cuts, n).tolist()))


def packed_fragments(texts: DataFrame, n_buckets: int) -> DataFrame:
    """bucket, marks, ids, row_keys, starts, lengths, bytes of the fragments to
    compare.  ``texts`` has id, row_key, packed and parts (``shared_starts``)."""
    names = ["bucket", "marks", "ids", "row_keys", "starts", "lengths", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = _longs(batch.column(0)), _longs(batch.column(1))
            wanted = [np.frombuffer(p, np.int32).reshape(-1, 2) for p in batch.column(3).to_pylist()]
            data, off = _texts(batch.column(2))
            parts = []
            for a, b, d, o in textnp.chunks(data, off):
                row, start, length, value = minimizers(d, o)
                bounds = np.searchsorted(row, np.arange(b - a + 1))
                places = [(lo + np.searchsorted(start[lo:hi], w[:, 0]), w[:, 1] > 0) for lo, hi, w in
                          zip(bounds[:-1], bounds[1:], wanted[a:b])]
                take = np.concatenate([p for p, _ in places]).astype(np.int64)
                hot = np.concatenate([h for _, h in places])
                row, start, length, value = row[take], start[take], length[take], value[take]
                if hot.any():  # each string of these on its own, dealt by its own bytes
                    many = np.where(hot, length, 1)
                    within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    row, hot, length, value = (np.repeat(c, many) for c in (row, hot, length, value))
                    start = np.repeat(start, many) + np.where(hot, within, 0)
                    length[hot] = 1
                    strings = d[(o[row[hot]] + start[hot])[:, None] + np.arange(WIDTH)]
                    value[hot] = textnp.mix64((strings * _STRING).sum(axis=1, dtype=np.uint64))
                parts.append((a + row, off[a] + o[row] + start, start.astype(np.int32), length + WIDTH - 1, value))
            row, begin, start, size, value = (np.concatenate(c) for c in zip(*parts))
            columns = [value.astype(np.uint32), ids[row], keys[row], start, size.astype(np.uint8)]
            out = []
            for bucket, at in _by_bucket(value, n_buckets):
                flat = np.arange(size[at].sum()) + np.repeat(begin[at] - (np.cumsum(size[at]) - size[at]), size[at])
                out.append((bucket, *_pack(columns, at), textnp.squeeze(data[flat].tobytes())))
            yield _binary_rows(out, names)
    return texts.select("id", "row_key", "packed", "parts").mapInArrow(
        run, "bucket int, marks binary, ids binary, row_keys binary, starts binary, lengths binary, bytes binary")


class Columns:
    """A round's columns of the index, in files of the task's own folder: each
    round reads its predecessor's from front to back and writes its own.  The
    files stay open and are overwritten in place (columns only grow)."""

    KINDS = (("symbols", np.uint8), ("places", np.int32), ("offsets", np.uint8), ("common", np.uint8))

    def __init__(self, folder: str, stack: ExitStack):
        self.files = [[stack.enter_context(open(os.path.join(folder, f"{name}.{k}"), "w+b")) for k in (0, 1)]
                      for name, _ in self.KINDS]
        self.turn, self.length = 0, 0

    def write(self, *columns: tuple[np.ndarray, np.ndarray]) -> None:
        """Each column as two parts, one after the other."""
        self.turn ^= 1
        self.length = sum(map(len, columns[0]))
        for pair, (_, kind), parts in zip(self.files, self.KINDS, columns):
            pair[self.turn].seek(0)
            for part in parts:
                pair[self.turn].write(part.astype(kind, copy=False).data)

    def read(self) -> list[np.ndarray]:
        out = []
        for pair, (_, kind) in zip(self.files, self.KINDS):
            pair[self.turn].seek(0)
            column = np.empty(self.length, kind)
            pair[self.turn].readinto(column.data)
            out.append(column)
        return out


def _least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least value of each range [lo, hi), by tables of powers of two, one at
    a time."""
    out = np.empty(len(lo), values.dtype)
    power = np.log2(hi - lo).astype(np.int64)
    power -= (1 << power) > hi - lo
    table, k = values, 0
    while True:
        at = np.flatnonzero(power == k)
        out[at] = np.minimum(table[lo[at]], table[hi[at] - (1 << k)])
        if k >= power.max(initial=0):
            return out
        table = np.minimum(table[:-(1 << k)], table[1 << k:])
        k += 1


def collection_index(text: np.ndarray, ends: np.ndarray, sizes: np.ndarray, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """(places, common): the collection's suffixes in order, as places in
    ``text``, and each one's common prefix with the one before, at most WIDTH.

    ``text`` has no symbol 0 but one before each of its texts; ``ends`` is one
    past each text's last symbol, ``sizes`` (descending) their lengths.  In
    each round every text gets one symbol; shorter texts begin later, so that
    all end together.  Sorting the transform's symbols, stably, gives the
    order of the suffixes that they start (the place of a suffix cX is the
    rank of its c).  Old neighbours keep their common prefix; a new suffix and
    its successor get 1 + the least between the two suffixes that they
    extend."""
    rounds = int(sizes[0])
    begun = np.searchsorted(-sizes, -np.arange(rounds, 0, -1), side="right")  # texts that have begun, by round
    last, ends, sizes = text[ends - 1], ends.astype(np.int32), sizes.astype(np.uint8)
    zeros = np.zeros(len(ends), np.uint8)
    symbols, places, offsets, common = zeros[:0], ends[:0], zeros[:0], zeros[:0]
    with ExitStack() as stack:
        columns = Columns(folder, stack)
        for turn, m in enumerate(begun.tolist(), start=1):
            # the empty suffixes of the texts that have begun come first
            columns.write((last[:m], symbols), (ends[:m], places), (sizes[:m], offsets), (zeros[:m], common))
            symbols, places, offsets, common = columns.read()
            counts = np.bincount(symbols, minlength=256)
            source = np.argsort(symbols, kind="stable")[counts[0]:]
            places, offsets = places.take(source), offsets.take(source)
            places -= 1
            offsets -= np.uint8(1)
            added = np.flatnonzero(offsets == rounds - turn)
            found = np.empty(len(source), np.uint8)
            kept = np.ones(len(source), bool)
            kept[added] = False
            found[kept] = common[m:]
            # a new suffix and its successor, unless they are the first of their symbol
            heads = np.zeros(len(source) + 1, bool)
            heads[np.cumsum(counts[1:])] = True
            heads[0] = True
            again = np.zeros(len(source) + 1, bool)
            again[added] = again[added + 1] = True
            found[(again & heads)[:-1]] = 0
            rest = np.flatnonzero((again & ~heads)[:-1])
            found[rest] = np.minimum(_least(common, source[rest - 1] + 1, source[rest] + 1) + np.uint8(1), WIDTH)
            symbols, common = text.take(places - 1), found
    return places, common


def may_share(pieces: list[bytes]) -> np.ndarray:
    """Which of the distinct pieces can hold a WIDTH-byte string of another.

    Equal strings hold their minimizer at the same place, so the bytes around
    it are equal too.  By that place, strings fall into classes of ``PLACES``;
    a piece stays where a class's common bytes around its minimizer occur in
    another piece.  A minimizer that occurs twice in a piece leaves the place
    open: all pieces of that minimizer stay."""
    sizes = np.array(list(map(len, pieces)))
    first = np.append(0, np.cumsum(sizes))
    data = np.frombuffer(b"".join(pieces), np.uint8)
    h = seed_hashes(data)
    beyond = (first[1:, None] - np.arange(1, SEED)).ravel()  # these reach into the next piece
    h[beyond[beyond < len(h)]] = ~_U(0)
    least = np.minimum.reduceat(h, first[:-1])
    found = np.flatnonzero(h == np.repeat(least, sizes)[:len(h)])
    piece = np.searchsorted(first, found, side="right") - 1
    once = np.bincount(piece, minlength=len(pieces)) == 1
    keep = np.isin(least, least[~once])
    sure = once[piece]
    found, piece = found[sure], piece[sure]
    for lo in range(0, RUN, PLACES):
        hi = min(lo + PLACES, RUN) - 1
        size = lo + WIDTH - hi
        fits = (found - lo >= first[piece]) & (found - lo + size <= first[piece + 1])
        around = data[(found[fits] - lo)[:, None] + np.arange(size)]
        _, group, members = np.unique(textnp.mix64((around * _STRING[:size]).sum(axis=1, dtype=np.uint64)),
                                      return_inverse=True, return_counts=True)
        keep[piece[fits][members[group] > 1]] = True
    return keep


def least_owners(pieces: list[bytes], owners: np.ndarray, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """For distinct pieces and each one's least document: (first, least),
    where ``least[first[i] + w]`` is the least document that holds the
    WIDTH-byte string at ``w`` of piece i."""
    order = sorted(range(len(pieces)), key=lambda i: -len(pieces[i]))
    sizes = np.array([len(pieces[i]) for i in order])
    joined = np.frombuffer(b"\xff".join([b"", *[pieces[i] for i in order]]), np.uint8)
    # UTF-8 has no byte FF: it marks the bounds (0 there), and stands for byte 0
    text = joined.copy()
    text[joined == 0] = 0xFF
    bounds = np.append(0, np.cumsum(sizes[:-1] + 1))
    text[bounds] = 0
    ends = bounds + 1 + sizes
    places, common = collection_index(text, ends, sizes, folder)
    piece = np.repeat(np.arange(len(pieces)), sizes + 1)
    # suffixes shorter than WIDTH share less with any other, so runs stay runs without them
    whole = places <= ends[piece[places]] - WIDTH
    places, common = places[whole], common[whole]
    heads = np.flatnonzero(np.append(True, common[1:] < WIDTH))
    best = np.minimum.reduceat(owners[np.array(order)][piece[places]], heads)
    least = np.empty(len(text), np.int64)
    least[places] = np.repeat(best, np.diff(np.append(heads, len(places))))
    first = np.empty(len(pieces), np.int64)
    first[order] = bounds + 1
    return first, least


def covered_ranges(packed: DataFrame, n_blocks: int) -> DataFrame:
    """Byte ranges to remove, as start and end, for ``by_document``."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        mark, doc, key, start, size = (_column(rows, c, kind) for c, kind in (
            ("marks", np.uint32), ("ids", np.int64), ("row_keys", np.int64), ("starts", np.int32), ("lengths", np.uint8)))
        raw = b"".join(map(textnp.expand, rows["bytes"]))
        cut = np.append(0, np.cumsum(size.astype(np.int64))).tolist()
        number: dict[bytes, int] = {}
        piece = np.array([number.setdefault(raw[a:b], len(number)) for a, b in zip(cut[:-1], cut[1:])], np.int64)
        pieces = list(number)
        owners = np.full(len(pieces), np.iinfo(np.int64).max)
        np.minimum.at(owners, piece, doc)
        later = doc > owners[piece]  # an earlier document has the whole fragment
        found = [np.flatnonzero(later)], [start[later]], [start[later] + size[later]]
        # a least owner's strings may start earlier in another fragment of the same minimizer
        mark_of = np.empty(len(pieces), np.uint32)
        mark_of[piece] = mark
        _, group, members = np.unique(mark_of, return_inverse=True, return_counts=True)
        several = members[group] > 1
        chosen = np.flatnonzero(several)
        if len(chosen):
            several[chosen] = may_share([pieces[i] for i in chosen.tolist()])
        own = np.flatnonzero(~later & several[piece])
        if len(own):
            chosen = np.flatnonzero(several)
            first = np.zeros(len(pieces), np.int64)
            with tempfile.TemporaryDirectory() as folder:
                first[chosen], least = least_owners([pieces[i] for i in chosen.tolist()], owners[chosen], folder)
            count = size[own].astype(np.int64) - WIDTH + 1
            bounds = np.append(0, np.cumsum(count))
            at = np.repeat(first[piece[own]] - bounds[:-1], count) + np.arange(bounds[-1])
            gone = least[at] < np.repeat(doc[own], count)
            # runs of such strings; a fragment's strings follow each other
            flags = np.zeros(bounds[-1] + len(own) + 1, np.int8)
            flags[1 + np.arange(bounds[-1]) + np.repeat(np.arange(len(own)), count)] = gone
            change = np.diff(flags)
            begin, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
            spread = bounds[:-1] + np.arange(len(own))
            of = np.searchsorted(spread, begin, side="right") - 1
            for column, more in zip(found, (own[of], start[own[of]] + begin - spread[of], start[own[of]] + end - spread[of] + WIDTH - 1)):
                column.append(more)
        at, first, last = (np.concatenate(c) for c in found)
        return _dealt(doc[at], key[at], first.astype(np.int32), last.astype(np.int32), n_blocks)
    return packed.groupBy("bucket").applyInPandas(run, _DEALT)


def cut_ranges(texts: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept of rows with
    doc_id, packed, copy (an earlier document has the whole text) and parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = _texts(batch.column(1))
            out: list[tuple] = []
            for copy, parts, a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), off[:-1], off[1:]):
                raw, n = data[a:b], int(b - a)
                if copy and n >= WIDTH:
                    out.append((n, n, 1, b""))
                elif parts:
                    edges = np.frombuffer(parts, np.int32).reshape(-1, 2)
                    depth = np.zeros(n + 1, np.int32)
                    np.add.at(depth, edges[:, 0], 1)
                    np.add.at(depth, edges[:, 1], -1)
                    gone = np.cumsum(depth[:-1]) > 0
                    spans = int((np.diff(np.append(0, gone.astype(np.int8))) == 1).sum())
                    out.append((n, int(gone.sum()), spans, raw[~gone].tobytes()))
                else:
                    out.append((n, 0, 0, raw.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([o[k] for o in out], pa.int64()) for k in range(3)],
                 pa.array([hashlib.sha256(o[3]).hexdigest() for o in out], pa.string()), pa.array([o[3] for o in out], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    return texts.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal
    removed runs), kept_sha256, kept (the remaining bytes)."""
    text = F.coalesce("text", F.lit(""))
    texts = docs.select("doc_id", F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"),
                        F.xxhash64(F.coalesce("doc_id", F.lit(NULL_ID)), text).alias("row_key"), text.alias("text"))
    digests = texts.select("id", "row_key", F.unhex(F.sha2("text", 256)).alias("digest"))
    firsts = digests.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first != last")
    copies = materialize(digests.join(firsts, "digest").filter("id != first").select("id", "row_key").distinct(), "copies")

    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    packed = packed_minimizers(texts, blocks_for(size // 18, KEYS_PER_BUCKET))
    blocks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), blocks_for(size, TEXT_BYTES_PER_BLOCK))
    # written before the join, so that it takes one row per document
    shared = materialize(by_document(shared_starts(packed, blocks)), "shared").join(copies, ["id", "row_key"], "left_anti")
    total = int(shared.agg(F.sum("n")).first()[0] or 0)
    small = squeezed(texts)
    chosen = small.select("id", "row_key", "packed").join(shared.select("id", "row_key", "parts"), ["id", "row_key"])
    fragments = packed_fragments(chosen, blocks_for(total * (WIDTH + RUN // 2), FRAGMENT_BYTES_PER_BUCKET))
    cuts = materialize(by_document(covered_ranges(fragments, blocks)), "ranges").select("id", "row_key", "parts", F.lit(False).alias("copy"))
    whole = copies.select("id", "row_key", F.lit(None).cast("binary").alias("parts"), F.lit(True).alias("copy"))
    joined = small.join(cuts.unionByName(whole), ["id", "row_key"], "left")
    return cut_ranges(joined.select("doc_id", "packed", "copy", "parts"))
