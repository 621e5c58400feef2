"""Quality classifier: Bradley-Terry ranking of documents.

A document's score is linear in shape features of its text (shares of
character classes, word lengths, repetition).  The weights are learnt from
preference pairs (a document labelled 1 beats one labelled 0): logistic loss
on the difference of their features, by Newton steps with a small ridge.
The threshold is the score quantile at the share of labels 0, over all agreed
labelled documents outside the held-out fold (exact, from histograms), and
scores are mapped to 0..1 so that the threshold lies at ``THRESHOLD``.

The weights are learnt from at most ``MAX_LABELLED`` labelled rows of each class, those
lowest by a hash of doc_id (a documented bound: only their feature vectors
reach the driver); every document is scored over its whole text.

Defined results: a null or empty text has zero features and is scored like
any other; labels that are null, repeat with different values, or have no
document are ignored; without both classes there is no model and every score
is 1; repeated rows are scored alike; of a labelled doc_id with several texts
the one with the least hash is learned from.  Labels, lang, source and doc_id are
never features.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import textnp
from tessera.llm.common import materialize

MAX_LABELLED = 10_000
PAIRS_PER_ROW = 8
RIDGE = 1e-3
STEPS = 50
THRESHOLD = 0.7
HELD_OUT = 2

_BYTES = np.arange(256)
_CLASSES = [
    (_BYTES >= 65) & (_BYTES <= 90), (_BYTES >= 97) & (_BYTES <= 122), (_BYTES >= 48) & (_BYTES <= 57),
    textnp.SPACE, _BYTES == 10, _BYTES >= 128, np.isin(_BYTES, list(b".,;:'\"()-")), np.isin(_BYTES, list(b"!?")),
    (_BYTES > 32) & (_BYTES < 127) & ~np.isin(_BYTES, list(b".,;:'\"()-!?"))
    & ~((_BYTES >= 65) & (_BYTES <= 90)) & ~((_BYTES >= 97) & (_BYTES <= 122)) & ~((_BYTES >= 48) & (_BYTES <= 57)),
]
_CLASS_OF = np.zeros(256, np.uint8)
for _k, _members in enumerate(_CLASSES, start=1):
    _CLASS_OF[_members] = _k
N_FEATURES = 18
_WORD_CODES = textnp.word_codes(True, ~textnp.SPACE)


def _features_of_chunk(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    out = np.zeros((len(off) - 1, N_FEATURES))
    kind = _CLASS_OF[data]
    starts, ends = textnp.runs(~textnp.SPACE[data], off)
    words = textnp.span_hashes(data, starts, ends, _WORD_CODES)
    five = textnp.window_hashes(words, 5, 11)
    lengths = ends - starts
    last_kind = kind[ends - 1]
    first_word = np.searchsorted(starts, off)
    for i in range(len(off) - 1):
        a, b = off[i], off[i + 1]
        wa, wb = first_word[i], first_word[i + 1]
        n, m = b - a, wb - wa
        if n == 0 or m == 0:
            continue
        share = np.bincount(kind[a:b], minlength=len(_CLASSES) + 1) / n
        row = out[i]
        row[:10] = share[:10]
        length = lengths[wa:wb]
        row[10], row[11] = length.mean() / 10, (length <= 4).mean()
        row[12] = (length >= 20).mean()
        row[13] = len(np.unique(words[wa:wb])) / m
        row[14] = (words[wa + 1:wb] == words[wa:wb - 1]).sum() / m
        row[15] = len(np.unique(five[wa:wb - 4])) / (m - 4) if m > 4 else 1.0
        row[16] = (last_kind[wa:wb] >= 8).mean()
        row[17] = np.log1p(m) / 10
    return out


def features(column: pa.Array) -> np.ndarray:
    data, off = textnp.column_bytes(column)
    parts = [_features_of_chunk(d, o) for _, _, d, o in textnp.chunks(data, off)]
    return np.concatenate(parts) if parts else np.zeros((0, N_FEATURES))


def _agreed(labels: DataFrame) -> DataFrame:
    """label_id, label of the documents with one label, without the held-out."""
    return (labels.filter("quality in (0, 1) and doc_id is not null").groupBy("doc_id")
            .agg(F.min("quality").alias("label"), F.max("quality").alias("most")).filter("label = most")
            .filter(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) != HELD_OUT)
            .select(F.col("doc_id").alias("label_id"), "label"))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """label, features of the training rows: (label int, n_rows long, f array)."""
    agreed = _agreed(labels)
    picked = [agreed.filter(F.col("label") == k).orderBy(F.xxhash64("label_id"), "label_id").limit(MAX_LABELLED) for k in (0, 1)]
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    rows = texts.join(picked[0].unionByName(picked[1]), F.col("doc_id") == F.col("label_id")).select("doc_id", "label", "text", "h")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = features(batch.column(2))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(f) + 1) * N_FEATURES, pa.int32()), pa.array(f.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), lists], names=["doc_id", "label", "h", "f"])
    found = rows.mapInArrow(extract, "doc_id long, label int, h long, f array<double>")
    # of a doc_id's texts the one with the least hash
    return found.groupBy("doc_id").agg(F.min(F.struct("h", "label", "f")).alias("r")).select("doc_id", "r.label", "r.f")


def _ordered(bits: np.ndarray) -> np.ndarray:
    """Doubles' bits as longs of the same order, and back."""
    return np.where(bits < 0, bits ^ np.int64((1 << 63) - 1), bits)


def _threshold(docs: DataFrame, labels: DataFrame, weights: np.ndarray) -> float:
    """The value of f . weights with as many labelled documents below it as
    there are labels 0: between the two scores on either side."""
    @F.arrow_udf("long")
    def key(column: pa.Array) -> pa.Array:
        return pa.array(_ordered((features(column) @ weights + 0.0).view(np.int64)))
    keys = docs.select("doc_id", key(F.col("text")).alias("key"))
    rows = materialize(keys.join(_agreed(labels), F.col("doc_id") == F.col("label_id")).select("label", "key"), "labelled_scores")
    below = rows.filter("label = 0").count()
    prefix = None
    for shift in (48, 32, 16, 0):  # 65,536 bins each; the last ones are single scores
        inside = rows if prefix is None else rows.filter(F.shiftright("key", shift + 16) == prefix)
        bins = sorted(inside.groupBy(F.shiftright("key", shift).alias("bin")).count().collect())
        for prefix, n in bins:  # noqa: B007
            if below <= n:
                break
            below -= n
    lower = upper = prefix
    if below == n:  # no further score equals the lower one
        upper = rows.filter(F.col("key") > lower).agg(F.min("key")).first()[0]
    ends = _ordered(np.array([lower, lower if upper is None else upper], np.int64)).view(np.float64)
    return float(ends.mean())


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float] | None:
    """(weights, offset) so that sigmoid(f . weights + offset) is the score."""
    rows = sorted((r.doc_id, r.label, r.f) for r in _labelled(docs, labels).collect())  # bounded: 2 * MAX_LABELLED rows
    label = np.array([r[1] for r in rows], int)
    if len(set(label.tolist())) < 2:
        return None
    x = np.array([r[2] for r in rows])
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1
    x = (x - mean) / scale
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    pairs = PAIRS_PER_ROW * max(len(good), len(bad))
    k = np.arange(pairs)
    rng = np.random.default_rng(0)
    difference = x[good[rng.permutation(pairs) % len(good)]] - x[bad[k % len(bad)]]
    w = np.zeros(x.shape[1])
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(np.clip(difference @ w, -500, 500)))  # chance that the pair is ranked wrongly
        gradient = difference.T @ p / pairs - RIDGE * w
        hessian = (difference * (p * (1 - p))[:, None]).T @ difference / pairs + RIDGE * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    else:
        raise RuntimeError(f"no weights within {STEPS} Newton steps")
    weights = w / scale
    return weights, float(np.log(THRESHOLD / (1 - THRESHOLD)) - _threshold(docs, labels, weights))


def score(text: Column, model: tuple[np.ndarray, float] | None) -> Column:
    """Score of a text, 0 to 1."""
    if model is None:
        return F.lit(1.0)
    weights, offset = model

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        return pa.array(1 / (1 + np.exp(-np.clip(features(column) @ weights + offset, -500, 500))))
    return scored(text)


def rank(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = docs.select("doc_id", score(F.col("text"), fit(docs, labels)).alias("score"))
    return scored.select("doc_id", F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == HELD_OUT,
                                              F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score reaches the threshold, with docs' columns."""
    packed = docs.select(F.struct("*").alias("row"), score(F.col("text"), fit(docs, labels)).alias("score"))
    return packed.filter(F.col("score") >= THRESHOLD).select("row.*")
