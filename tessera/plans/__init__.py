"""Named query plans over the test tables.

Each plan is a function ``(spark, sf_dir) -> DataFrame`` registered with an
optional ANSI-SQL equivalent (the oracle, runnable by DuckDB on the same
parquet tables).  Plans without an oracle are non-deterministic or not
expressible in plain SQL and get a weaker rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = (fn, oracle)
        return fn
    return deco


def load_all() -> dict[str, tuple[QueryFn, str | None]]:
    # Importing the modules fills REGISTRY.
    from tessera.plans import analytics, quality, ingest, ordering, streams, lakehouse, versions  # noqa: F401
    return REGISTRY
