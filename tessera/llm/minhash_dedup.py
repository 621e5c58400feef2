"""Near-duplicate documents by b-bit MinHash.

A document's set is its distinct 5-word shingles.  ``HASHES`` minima make a
signature; ``BANDS`` bands of ``ROWS`` minima give the candidate keys, and of
every minimum only ``BITS`` low bits are kept, packed in ``HASHES * BITS / 64``
longs.  For pairs that share a key, the similarity is estimated by counting
equal groups of bits and correcting for chance collisions,
(equal share - 2^-b) / (1 - 2^-b); estimates far below the threshold
(``SLACK`` standard deviations) are dropped, the rest confirmed on full sets.

Equal sets are one node from the start.  Within a key no list of all pairs
is made.  First each node is compared with one other: the least node of the
keys it has, that with which it shares most of them.  These links are joined
to components.  Keys that then lie in one component are settled.  In the
others the members of different components are compared in blocks: a task
gets the sets of two blocks of a key's members (each bounded in rows and in
shingles), counts their common shingles, and emits links between components
only, at most one less than it has components.  So every two nodes that share
a key end in one component or have been compared on full sets; with these
bands a pair at the threshold shares no key once in 200,000.

A key that a third of all rows share is pre-aggregated (least node, counts)
before the shuffle; its blocks go to tasks of their own.  Signatures and sets
are joined with joins whose skewed partitions AQE splits.

Defined results: a document without words links with nothing; fewer than
five words are one shingle; a null text has no words; a null doc_id counts
as the least id, and rows with a null doc_id are told apart by a hash of the
text (the least one is kept); rows that repeat another doc_id are one
document, linked through each of their sets; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import textnp
from tessera.llm.common import materialize
from tessera.llm.components import connected_components, merge_labels

HASHES, ROWS, BITS = 128, 4, 2
BANDS = HASHES // ROWS
LONGS = HASHES * BITS // 64
SHINGLE = 5
THRESHOLD = 75  # percent
SLACK = 4.5
BLOCK_NODES = 512
BLOCK_SHINGLES = 1 << 20
MATCHES = 1 << 20  # common shingles that a task counts at once
NULL_ID = -(1 << 63)

_A = (textnp.constants(HASHES, 21) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_C = (textnp.constants(HASHES, 22) >> np.uint64(32)).astype(np.uint32)
_BAND_SEED = textnp.constants(BANDS, 23)


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    """Signatures (rows x HASHES, 32 bits) of non-empty sets."""
    out = np.empty((len(sets), HASHES), np.uint32)
    for i, s in enumerate(sets):
        x = (s >> np.uint64(32)).astype(np.uint32)
        least = None
        for k in range(0, len(x), 2048):
            part = (_A[:, None] * x[None, k:k + 2048] + _C[:, None]).min(axis=1)
            least = part if least is None else np.minimum(least, part)
        out[i] = least
    return out


def _band_keys(minima: np.ndarray) -> np.ndarray:
    grouped = minima.reshape(len(minima), BANDS, ROWS).astype(np.uint64)
    key = np.repeat(_BAND_SEED[None, :], len(minima), axis=0)
    for r in range(ROWS):
        key = textnp.mix64(key ^ grouped[:, :, r])
    return key.view(np.int64)


def _packed(minima: np.ndarray) -> np.ndarray:
    """The low BITS of each (mixed) minimum, packed into longs."""
    low = textnp.mix64(minima.astype(np.uint64)) & np.uint64((1 << BITS) - 1)
    per = 64 // BITS
    shifts = (np.arange(per, dtype=np.uint64) * np.uint64(BITS))[None, None, :]
    return np.bitwise_or.reduce(low.reshape(len(minima), LONGS, per) << shifts, axis=2).view(np.int64)


def _list_column(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(values.ravel()))


def _tie() -> Column:
    """Tells rows with a null doc_id apart; 0 for the others."""
    return F.when(F.col("doc_id").isNull(), F.xxhash64(F.coalesce("text", F.lit("")))).otherwise(F.lit(0).cast("bigint"))


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, tie, n_shingles, node (digest of the set, null if empty), sig
    (packed bits), keys (band keys)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = textnp.column_bytes(batch.column(1))
            for a, b, d, o in textnp.chunks(data, off):
                sets = list(textnp.shingle_sets(d, o, SHINGLE))
                filled = [s if len(s) else np.zeros(1, np.uint64) for s in sets]
                minima = _minima(filled)
                nodes = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(nodes, pa.binary()), _list_column(_packed(minima)), _list_column(_band_keys(minima))],
                    names=["doc_id", "tie", "n_shingles", "node", "sig", "keys"])
    return docs.select("doc_id", "text", _tie().alias("tie")).mapInArrow(
        run, "doc_id long, tie long, n_shingles long, node binary, sig array<long>, keys array<long>")


def shingle_table(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, grams (its sorted 64-bit shingle hashes) of the given nodes
    (node, any_id and any_tie: a document that has the node's set)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = textnp.column_bytes(batch.column(1))
            for a, b, d, o in textnp.chunks(data, off):
                grams = [s.tobytes() for s in textnp.shingle_sets(d, o, SHINGLE)]
                digests = [hashlib.blake2b(g, digest_size=16).digest() for g in grams]
                keep = pa.array([x == y for x, y in zip(digests, batch.column(0).slice(a, b - a).to_pylist())], pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(grams, pa.binary())],
                                                 names=["node", "grams"]).filter(keep)
    texts = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("any_id"), _tie().alias("any_tie"), "text")
    found = (texts.join(nodes.select("node", "any_id", "any_tie"), ["any_id", "any_tie"])
             .select("node", "text").mapInArrow(run, "node binary, grams binary"))
    return found.groupBy("node").agg(F.min("grams").alias("grams"))  # repeated rows give a set twice


def estimate(one: str, two: str) -> Column:
    """Collision-corrected similarity of two packed signatures."""
    pattern = F.lit(sum(1 << (BITS * i) for i in range(64 // BITS)) - (1 << 64) * (BITS == 1))
    unequal = F.lit(0)
    for k in range(LONGS):
        x = F.col(one)[k].bitwiseXOR(F.col(two)[k])
        folded = x
        for s in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, s))
        unequal = unequal + F.bit_count(folded.bitwiseAND(pattern))
    chance = 2.0 ** -BITS
    return ((1 - unequal / HASHES) - chance) / (1 - chance)


def floor_of(threshold: float) -> float:
    """Estimates below this are dropped unconfirmed."""
    chance = 2.0 ** -BITS
    equal = chance + (1 - chance) * threshold
    return threshold - SLACK * (equal * (1 - equal) / HASHES) ** 0.5 / (1 - chance)


def confirm(pairs: DataFrame, grams: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach ``threshold`` percent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                one, two = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(one) + len(two) - len(np.unique(np.concatenate([one, two])))
                keep[i] = 100 * both >= threshold * (len(one) + len(two) - both)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep))
    left = grams.select(F.col("node").alias("a"), F.col("grams").alias("grams_a"))
    right = grams.select(F.col("node").alias("b"), F.col("grams").alias("grams_b"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "grams_a", "grams_b")
    return joined.mapInArrow(run, "a binary, b binary")


def _screened(pairs: DataFrame, sigs: DataFrame, least: float) -> DataFrame:
    left = sigs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"))
    right = sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"))
    return pairs.join(left, "a").join(right, "b").filter(estimate("sig_a", "sig_b") >= least).select("a", "b")


def _compare(threshold: int):
    """Links between components among the rows of one pair of blocks."""
    def group(table: pa.Table) -> pa.Table:
        nodes, sides = table.column("node").to_pylist(), np.array(table.column("side").to_pylist())
        _, label = np.unique(np.array(table.column("label").to_pylist(), object), return_inverse=True)
        grams, off = textnp.column_bytes(table.column("grams"))
        values, at = grams.view(np.uint64), off // 8
        size, owner = np.diff(at), np.repeat(np.arange(len(nodes)), np.diff(at))
        order = np.argsort(values, kind="stable")
        ranked, owners = values[order], owner[order]
        up = np.arange(label.max() + 1)
        out: tuple[list, list] = [], []

        def root(k: int) -> int:
            while up[k] != k:
                up[k] = up[up[k]]
                k = up[k]
            return k
        # two nodes of different components aren't both of the largest one
        largest = int(np.bincount(label, weights=size).argmax())
        alone = (sides == 0).all()  # a block with itself
        for j in np.flatnonzero(label != largest):
            mine = values[at[j]:at[j + 1]]
            lo, hi = np.searchsorted(ranked, mine, "left"), np.searchsorted(ranked, mine, "right")
            n, both = hi - lo, np.zeros(len(nodes), np.int64)
            ends, k = np.cumsum(n), 0
            while k < len(mine):
                stop = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + MATCHES, "right")))
                part = n[k:stop]
                places = np.repeat(lo[k:stop] - np.append(0, np.cumsum(part)[:-1]), part) + np.arange(part.sum())
                both += np.bincount(owners[places], minlength=len(nodes))
                k = stop
            near = (100 * both >= threshold * (size + size[j] - both)) & (label != label[j])
            near &= ((label == largest) | (np.arange(len(nodes)) < j)) if alone else (sides != sides[j])
            for i in np.flatnonzero(near).tolist():
                x, y = root(label[i]), root(label[j])
                if x != y:
                    up[max(x, y)] = min(x, y)
                    out[0].append(nodes[i])
                    out[1].append(nodes[j])
        return pa.table({"a": pa.array(out[0], pa.binary()), "b": pa.array(out[1], pa.binary())})
    return group


def block_links(members: DataFrame, tried: DataFrame, labels: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """a, b: links between nodes that share a key and lie in different
    components.  A key of two nodes that were tried already has none."""
    placed = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    placed = placed.join(tried.select(F.col("b").alias("node"), F.col("a").alias("with")), "node", "left")
    is_open = (F.col("lo") != F.col("hi")) & ((F.col("n") > 2) | (F.col("tried") == 0))
    stats = placed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.max("n").alias("n"),
                                      F.max("shingles").alias("shingles"), F.count_if(F.col("with") == F.col("first")).alias("tried"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK_NODES, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    opened = placed.select("key", "node", "label").join(stats.filter(is_open).select("key", blocks.alias("blocks")), "key")
    mine = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    with_sets = opened.withColumn("mine", mine).join(sets, "node")
    rows = with_sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("mine", "other").alias("one"), F.greatest("mine", "other").alias("two"),
        (F.col("mine") > F.col("other")).cast("int").alias("side"), "node", "label", "grams")
    return rows.groupBy("key", "one", "two").applyInArrow(_compare(threshold), "a binary, b binary")


def _linked(docs: DataFrame, threshold: int) -> DataFrame:
    """``link``, with each row's ``tie``."""
    rows = materialize(signatures(docs), "signatures")
    ids = rows.select("tie", "n_shingles", "node", "sig", "keys", F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"))
    filled = ids.filter("node is not null")
    reps = materialize(filled.groupBy("node").agg(F.min(F.struct("id", "tie", "sig", "keys", "n_shingles")).alias("rep"))
                       .select("node", F.col("rep.id").alias("any_id"), F.col("rep.tie").alias("any_tie"), "rep.sig", "rep.keys", "rep.n_shingles"), "nodes")

    bands = reps.select("node", "n_shingles", F.explode("keys").alias("key"))
    shared = bands.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("n"), F.sum("n_shingles").alias("shingles")).filter("n > 1")
    members = materialize(bands.drop("n_shingles").join(shared, "key"), "members")
    in_key = materialize(reps.select("node", "any_id", "any_tie", "sig").join(members.select("node").distinct(), "node"), "candidates")
    # a document may have several sets only where rows repeat its doc_id
    named_rows = filled.filter(F.col("id") != NULL_ID)
    several = named_rows.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a != z")
    same_id = named_rows.join(several, "id").filter("node != a").select("a", F.col("node").alias("b")).distinct()

    sets = materialize(shingle_table(docs, in_key), "sets")
    firsts = members.filter("node != first").groupBy("node", "first").agg(F.count("*").alias("common"))
    tried = materialize(firsts.groupBy(F.col("node").alias("b")).agg(F.max(F.struct("common", "first")).alias("most"))
                        .select(F.col("most.first").alias("a"), "b"), "tried")
    links = confirm(_screened(tried, in_key, floor_of(threshold / 100)), sets, threshold).unionByName(same_id)
    labels = connected_components(materialize(links, "links"))
    more = materialize(block_links(members, tried, labels, sets, threshold), "links")
    if not more.isEmpty():
        labels = merge_labels(labels, more)

    named = ids.select("id", "tie", "node", "n_shingles").join(labels.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
    named = named.select(F.struct("id", "tie").alias("who"), "n_shingles", F.coalesce("label", "node").alias("label"))
    owners = named.filter("label is not null").groupBy("label").agg(F.min("who").alias("owner"))
    out = named.join(owners.withColumnRenamed("label", "owned"), F.col("label") == F.col("owned"), "left")
    out = out.select("who", "n_shingles", F.coalesce("owner", "who").alias("owner"))
    null_safe = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return out.select(null_safe("who.id").alias("doc_id"), F.col("who.tie").alias("tie"), "n_shingles",
                      null_safe("owner.id").alias("component_id"), (F.col("who") == F.col("owner")).alias("kept"))


def link(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return _linked(docs, threshold).drop("tie")


def keep_one(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """The document with the least id of each component, with docs' columns;
    of rows that repeat its id (null: its id and text), the one whose text's
    hash is least."""
    linked = _linked(docs, threshold).groupBy(F.col("doc_id").alias("kept_id"), F.col("tie").alias("kept_tie")).agg(
        F.bool_and("kept").alias("kept"), F.count("*").alias("n"))
    chosen = materialize(linked.filter("kept").select("kept_id", "kept_tie", "n"), "kept")
    packed = docs.select(F.struct("*").alias("row"), "doc_id", "text", _tie().alias("tie"))
    rows = packed.join(chosen, F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("tie") == F.col("kept_tie")))
    if chosen.filter("n > 1").isEmpty():
        return rows.select("row.*")
    order = Window.partitionBy("doc_id", "tie").orderBy(F.xxhash64("text"), "text")
    many = rows.filter("n > 1").withColumn("nth", F.row_number().over(order)).filter("nth = 1")
    return rows.filter("n = 1").select("row.*").unionByName(many.select("row.*"))
