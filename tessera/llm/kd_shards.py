"""Sharding by a k-d tree over metadata of the documents.

The table is split recursively at weighted medians: a node's documents are
ordered along the dimension in which it is widest (size, language, source,
each scaled to 0..1), and the cut halves its bytes.  All nodes of a level
are split at once.  A cut is found by histograms: each round sums the bytes
of 256 equal bins between a node's bounds (a map-side combined aggregation),
keeps the bin that holds the half and refines it, first along the dimension
until one value is left, then among the documents of that value along a hash
of the text.  So one source or size that holds a third of all rows is cut
like any other.

Equal texts take the metadata of their group's smallest language and source
and so stay together, unless the cut falls on a group whose bytes exceed
``GROUP_SHARE`` of a shard: that one is cut along a hash of doc_id.  The driver sees one row per node, bin and round.  Slots are numbered
in hash blocks of bounded size with offsets from the block counts, so no
window holds a whole shard.

Defined results: a null text has no bytes; a document's size is its bytes
plus 1, so empty documents count too; null metadata lie below all values;
rows that repeat a doc_id get slots of their own; an empty table gives no
rows.  Only doc_id, text, lang and source are read; added columns replace
none of theirs because the result is built from them alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import blocks_for, materialize, size_bytes

BINS = 256
ROWS_PER_BLOCK = 20_000
GROUP_SHARE = 0.05
DIMS = ["d_size", "d_lang", "d_source"]
_CUTS = "node long, axis int, need double, lo double, hi double, stage int, key double, below long"
_TWO53 = float(1 << 53)


def points_of(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, crc, tie (0..1, from the text) and
    the coordinates."""
    text = F.coalesce("text", F.lit(""))
    unit = lambda c: F.coalesce((F.crc32(c.cast("binary")) + 1) / float(1 << 32), F.lit(0.0))
    base = docs.select("doc_id", (size_bytes(F.col("text")) + 1).alias("size"), F.crc32(text.cast("binary")).alias("crc"),
                       (F.shiftrightunsigned(F.xxhash64(text), 11) / _TWO53).alias("tie"),
                       unit(F.col("lang")).alias("lang_at"), unit(F.col("source")).alias("source_at"))
    groups = base.groupBy("tie", "size").agg(F.min("lang_at").alias("d_lang"), F.min("source_at").alias("d_source"))
    return base.join(groups, ["tie", "size"]).select(
        "doc_id", "size", "crc", "tie", (F.log2("size") / 64).alias("d_size"), "d_lang", "d_source", F.lit(1).cast("bigint").alias("node"))


def _order() -> list[Column]:
    """What a node's documents are ordered by: the cut dimension, the text's
    hash, a hash of doc_id (anew in each node)."""
    dealt = F.shiftrightunsigned(F.xxhash64("doc_id", "node"), 11) / _TWO53
    return [F.element_at(F.array(*DIMS), F.col("axis") + 1), F.col("tie"), dealt]


def _find_cuts(points: DataFrame, leaf_bytes: float) -> list[dict]:
    """Each node's cut: the keys (one to three of ``_order``) up to which its
    documents go left, and whether those on the last key go along."""
    spark = points.sparkSession
    bounds = points.groupBy("node").agg(F.sum("size").alias("bytes"), *[F.min(d).alias(f"lo_{d}") for d in DIMS],
                                        *[F.max(d).alias(f"hi_{d}") for d in DIMS]).collect()
    cuts = []
    for row in bounds:
        widths = [row[f"hi_{d}"] - row[f"lo_{d}"] for d in DIMS]
        axis = widths.index(max(widths))
        cuts.append({"node": row.node, "axis": axis, "need": row.bytes / 2, "lo": row[f"lo_{DIMS[axis]}"],
                     "hi": row[f"hi_{DIMS[axis]}"], "keys": [], "below": 0, "with_last": None})
    while live := [c for c in cuts if c["with_last"] is None]:
        frame = F.broadcast(spark.createDataFrame(  # one row per node
            [(c["node"], c["axis"], c["lo"], c["hi"], c["keys"]) for c in live],
            "node long, axis int, lo double, hi double, keys array<double>"))
        order, stage = _order(), F.size("keys")
        pos = F.when(stage == 0, order[0]).when(stage == 1, order[1]).otherwise(order[2])
        fixed = ((stage < 1) | (order[0] == F.get("keys", F.lit(0)))) & ((stage < 2) | (order[1] == F.get("keys", F.lit(1))))
        at = points.join(frame, "node").filter(fixed).withColumn("pos", pos).filter(F.col("pos").between(F.col("lo"), F.col("hi")))
        cell = F.when(F.col("hi") > F.col("lo"), F.least(
            F.floor((F.col("pos") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS), F.lit(BINS - 1))).otherwise(F.lit(0))
        bins = at.groupBy("node", cell.alias("bin")).agg(
            F.sum("size").alias("bytes"), F.min("pos").alias("lo"), F.max("pos").alias("hi")).collect()
        for cut in live:
            own = sorted((b for b in bins if b.node == cut["node"]), key=lambda b: b.bin)
            for b in own:
                if cut["below"] + b.bytes >= cut["need"] or b is own[-1]:
                    break
                cut["below"] += b.bytes
            cut["lo"], cut["hi"] = b.lo, b.hi
            if b.lo == b.hi:  # one key left
                cut["keys"] = cut["keys"] + [b.lo]
                cut["lo"], cut["hi"] = 0.0, 1.0
                many = len(cut["keys"]) == 1 or (len(cut["keys"]) == 2 and b.bytes > GROUP_SHARE * leaf_bytes)
                if not many:
                    cut["with_last"] = cut["need"] - cut["below"] >= b.bytes / 2
    return cuts


def split_level(points: DataFrame, leaf_bytes: float) -> DataFrame:
    """Split every node in two halves by bytes: n becomes 2n and 2n + 1."""
    cuts = _find_cuts(points, leaf_bytes)
    if not cuts:
        return points
    frame = points.sparkSession.createDataFrame([(c["node"], c["axis"], c["keys"], c["with_last"]) for c in cuts],
                                                "node long, axis int, keys array<double>, with_last boolean")
    left = F.col("with_last")
    for k, place in reversed(list(enumerate(_order()))):
        key = F.get("keys", F.lit(k))
        left = F.when(key.isNull() | (place == key), left).otherwise(place < key)
    at = points.join(F.broadcast(frame), "node")
    return at.withColumn("node", F.col("node") * 2 + F.when(left, 0).otherwise(1)).select(*points.columns)


def _placed(docs: DataFrame, n_shards: int) -> DataFrame:
    """doc_id, size, crc, tie, shard, slot of each document."""
    points = materialize(points_of(docs), "points")
    total, rows = points.agg(F.sum("size"), F.count("*")).first()
    leaves = 1
    while leaves < n_shards:
        points = materialize(split_level(points, (total or 0) / n_shards), "level")
        leaves *= 2
    placed = points.select("doc_id", "size", "crc", "tie", (F.col("node") - n_shards).cast("int").alias("shard"),
                           F.pmod(F.xxhash64("doc_id", "tie"), F.lit(blocks_for(rows, ROWS_PER_BLOCK * n_shards))).alias("block"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "block").agg(F.count("*").alias("n")).select(
        "shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "block").orderBy("doc_id", "tie")
    return placed.withColumn("at", F.row_number().over(within) - 1).join(offsets, ["shard", "block"]).select(
        "doc_id", "size", "crc", "tie", "shard", (F.col("offset") + F.col("at")).cast("bigint").alias("slot"))


def shards(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """Columns: doc_id, size, text_crc32, law, shard, slot, grown_shard.
    ``n_shards`` is a power of two; a leaf's target is its share of all bytes."""
    return _placed(docs, n_shards).select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
                                          "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def place(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """The documents with their shard and slot added; columns of those names
    are replaced.  Rows alike in doc_id and text are interchangeable."""
    docs = docs.drop("shard", "slot")
    tie = (F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 11) / _TWO53).alias("text_tie")
    packed = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("row_id"), tie)
    numbered = packed.withColumn("nth", F.row_number().over(Window.partitionBy("row_id", "text_tie").orderBy(F.lit(0))))
    placed = _placed(docs, n_shards).withColumn(
        "place_nth", F.row_number().over(Window.partitionBy("doc_id", "tie").orderBy("shard", "slot")))
    joined = numbered.join(placed, F.col("row_id").eqNullSafe(F.col("doc_id")) & (F.col("text_tie") == F.col("tie"))
                           & (F.col("nth") == F.col("place_nth")))
    return joined.select("row.*", "shard", "slot")
