"""Connected components of an edge table by alternating large-star and
small-star steps (Kiveris et al., "Connected Components in MapReduce and
Beyond", 2014).

Both steps are an aggregation (least neighbour, combined before the shuffle)
and a join on the node, whose skewed partitions AQE splits; no node's
neighbours are gathered.  Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: link each node's larger neighbours to the least of it and its
    neighbours.  Small: link it and its smaller neighbours to their least."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))) if large else \
        both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:
        return joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
        least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a != b").distinct()


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Every node has one label and no label has another."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("label")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("label")))
    seen = ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("label").alias("label"))
    return seen.filter((F.col("child") > 1) | ((F.col("child") > 0) & (F.col("label") > 0))).isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """node, label (the component's least node) of every node that differs
    from its label.  ``edges`` has columns a and b of one ordered type."""
    stars = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "cc")
    while not _is_forest_of_stars(stars):
        stars = materialize(_star(_star(stars, True), False), "cc")
    return stars.select(F.col("a").alias("node"), F.col("b").alias("label"))


def merge_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, label) after new links (a, b) between nodes: only the
    labels that the links join are worked on."""
    of = labels.select(F.col("node").alias("n"), "label")
    ends = links
    for end in ("a", "b"):
        ends = ends.join(of.withColumnsRenamed({"n": f"n_{end}", "label": f"label_{end}"}), F.col(end) == F.col(f"n_{end}"), "left")
    ends = ends.select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    moved = materialize(connected_components(ends), "moved")
    new = moved.select(F.col("node").alias("old"), F.col("label").alias("new"))
    kept = labels.join(new, F.col("label") == F.col("old"), "left").select("node", F.coalesce("new", "label").alias("label"))
    return materialize(kept.unionByName(moved.select("node", "label")), "labels")
