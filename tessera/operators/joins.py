"""Join operators for star schemas: orphan checks, resolving semi joins,
denormalization and key-based comparison of two versions of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import guarded_broadcast


def orphans(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str) -> DataFrame:
    """Child rows whose foreign key has no parent (NULL keys excluded, as a
    FOREIGN KEY constraint allows them).  The parent side is reduced to its
    distinct keys and broadcast only when proven small."""
    keys = parent.select(F.col(parent_col).alias("_pk")).distinct()
    return child.where(F.col(child_col).isNotNull()).join(
        guarded_broadcast(keys), F.col(child_col) == F.col("_pk"), "left_anti")


def resolved(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str) -> DataFrame:
    """Child rows whose foreign key resolves (EXISTS)."""
    keys = parent.select(F.col(parent_col).alias("_pk")).distinct()
    return child.join(guarded_broadcast(keys), F.col(child_col) == F.col("_pk"), "left_semi")


def orphan_counts(edges: list[tuple[str, DataFrame, str, str, DataFrame, str]]) -> DataFrame:
    """One row per FK edge (child_table, fk_column, parent_table, orphans,
    child_rows).  ``edges`` holds (child_name, child_df, child_col,
    parent_name, parent_df, parent_col); all edges of one child frame are
    answered by one pass over it."""
    children: dict[int, list[tuple]] = {}
    for edge in edges:
        children.setdefault(id(edge[1]), []).append(edge)
    rows = []
    for group in children.values():
        child_name, child = group[0][:2]
        flagged = child.select(*[F.col(e[2]).alias(f"_fk{k}") for k, e in enumerate(group)])
        for k, (_, _, _, _, parent, pcol) in enumerate(group):
            keys = parent.select(F.col(pcol).alias(f"_pk{k}")).distinct()
            flagged = flagged.join(guarded_broadcast(keys), F.col(f"_fk{k}") == F.col(f"_pk{k}"), "left")
        missing = [F.count_if(F.col(f"_fk{k}").isNotNull() & F.col(f"_pk{k}").isNull()).alias(f"_n{k}") for k in range(len(group))]
        counts = flagged.agg(F.count(F.lit(1)).alias("child_rows"), *missing)
        per_edge = F.explode(F.array(*[F.struct(F.lit(child_name).alias("child_table"), F.lit(e[2]).alias("fk_column"),
                                                F.lit(e[3]).alias("parent_table"), F.col(f"_n{k}").alias("orphans"),
                                                F.col("child_rows")) for k, e in enumerate(group)]))
        rows.append(counts.select(per_edge.alias("e")).select("e.*"))
    return reduce(DataFrame.unionByName, rows)


def attach(fact: DataFrame, dim: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Join a dimension onto a fact, broadcasting it only when proven small."""
    return fact.join(guarded_broadcast(dim), on, how)


def compare_by_key(source: DataFrame, dest: DataFrame, keys: list[str],
                   value_cols: list[str]) -> DataFrame:
    """Full outer join of two versions of a table on ``keys`` and classify
    each key: missing (only in source), extra (only in dest), changed
    (values differ, NULL-safe) or same."""
    s = source.select(*keys, F.struct(*value_cols).alias("_s"))
    d = dest.select(*keys, F.struct(*value_cols).alias("_d"))
    j = s.join(d, keys, "full_outer")
    status = (F.when(F.col("_d").isNull(), F.lit("missing"))
              .when(F.col("_s").isNull(), F.lit("extra"))
              .when(~F.col("_s").eqNullSafe(F.col("_d")), F.lit("changed"))
              .otherwise(F.lit("same")))
    return j.select(*keys, status.alias("status"))
