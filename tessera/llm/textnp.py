"""NumPy text kernels used inside Arrow-batched tasks.

All kernels work on one flat byte buffer with document boundaries, so the
per-document Python overhead is a few slices.  Batches are cut into chunks
of bounded bytes; a longer document is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 4 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values (xor-shift and multiply)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(33)
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    return mix64((np.arange(1, n + 1, dtype=np.uint64) + _U(seed << 32)) * _U(0x9E3779B97F4A7C15))


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]] if len(off) else data[:0], off - off[0]


def squeeze(raw: bytes) -> bytes:
    """Zstandard-compressed bytes after their length; shuffles take these."""
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def expand(raw: bytes) -> bytes:
    return pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)


def chunks(data: np.ndarray, off: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of at most ``limit`` bytes (or one row): (first row, end
    row, bytes, offsets from 0)."""
    n, a = len(off) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, side="right")) - 1)
        yield a, b, data[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


def cut_by_bytes(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``limit`` bytes of one column (or one row)."""
    _, off = column_bytes(batch.column(column))
    a = 0
    while a < len(batch):
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, side="right")) - 1)
        yield batch.slice(a, b - a)
        a = b


def runs(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of maximal runs of True that stay within a document."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    left = np.empty(n, bool)
    left[0] = False
    left[1:] = inside[:-1]
    left &= ~edge[:-1]
    right = np.empty(n, bool)
    right[-1] = False
    right[:-1] = inside[1:]
    right &= ~edge[1:]
    return np.flatnonzero(inside & ~left), np.flatnonzero(inside & ~right) + 1


def value_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of per-byte ``values`` (0: the byte doesn't
    count).  Spans ascend and don't overlap; between them all values are 0."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    longest = int((ends - starts).max())
    powers = np.full(longest, 0x9E3779B97F4A7C15, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    at = np.arange(starts[0], ends[-1], dtype=np.int64) - np.repeat(starts, np.diff(np.append(starts, ends[-1])))
    np.minimum(at, longest - 1, out=at)
    weighed = values[starts[0]:ends[-1]] * powers[at]
    return mix64(np.add.reduceat(weighed, starts - starts[0]) + (ends - starts).astype(np.uint64))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """``value_hashes`` of bytes by their ``codes``."""
    return value_hashes(codes[data], starts, ends)


def word_codes(lower_ascii: bool, counted: np.ndarray) -> np.ndarray:
    codes = constants(256, 7)
    if lower_ascii:
        codes[65:91] = codes[97:123]
    codes[~counted] = 0
    return codes


def window_hashes(words: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hash of each run of ``n`` successive words (as if one document)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for j, c in enumerate(constants(n, seed) | _U(1)):
        total += words[j:len(words) - n + 1 + j] * c
    return mix64(total)


_SHINGLE_CODES = word_codes(True, ~SPACE)


def shingle_sets(data: np.ndarray, off: np.ndarray, n: int = 5) -> Iterator[np.ndarray]:
    """For each document its sorted distinct hashes of ``n``-word shingles;
    with fewer words the whole sequence as one; without words none."""
    starts, ends = runs(~SPACE[data], off)
    words = span_hashes(data, starts, ends, _SHINGLE_CODES)
    hashes = window_hashes(words, n, 11)
    first = np.searchsorted(starts, off)
    for a, b in zip(first[:-1], first[1:]):
        k = b - a
        if k == 0:
            yield words[:0]
        elif k < n:
            yield mix64(window_hashes(words[a:b], int(k), 11 + int(k)) + _U(int(k)))
        else:
            yield np.unique(hashes[a:b - n + 1])
