"""Session helpers: building a session, the shared scratch folder, and
size-checked broadcasts.

Library code never creates its own session; it takes the caller's.
``build_session`` is for tests, ``bench.py`` and local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job here relies on.  AQE re-plans joins at runtime
# (broadcast when the measured side is small, split skewed partitions)
# and coalesces small shuffle partitions.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf["spark.driver.memory"] = os.environ.get("TESSERA_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``.  Where the session names none, a local master
    gets a private folder; on a cluster that is an error, since executors
    don't share local folders."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory under the shared checkpoint folder, for
    tables that jobs write and read back (staging, sinks, stream state)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tessera/{name}-{uuid.uuid4().hex[:12]}"


def estimated_size(df: DataFrame) -> int | None:
    """Optimizer's size estimate of ``df`` in bytes (file sizes for scans,
    propagated through filters and projections); None if unavailable."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except Exception:  # pragma: no cover - e.g. Spark Connect sessions
        return None


def broadcast_limit(spark: SparkSession) -> int:
    """The session's own broadcast threshold in bytes; 0 when it forbids
    broadcasts."""
    value = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    return max(0, int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(value))
               if not value.lstrip("-").isdigit() else int(value))


def measured(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to scratch and read back: for a side that is small as a
    rule but that the optimizer can't know to be (missing keys, one row per
    group).  Its size is then that of its files, so ``guarded_broadcast`` can
    decide before the large side of the join is shuffled."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Stored bytes of input per shuffle partition (in memory they are some 20 times
# as many), and stored bytes of a hash join's build side per partition.
SHUFFLE_BYTES, BUILD_BYTES = 16 << 20, 4 << 20
_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle planned now starts with."""
    return int(spark.conf.get(_INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def sized_shuffles(spark: SparkSession, size: int | None):
    """Jobs run inside start their shuffles with partitions enough for ``size``
    bytes of input, so that what a task sorts or groups stays in memory however
    large the input; never fewer than the session's own, and adaptive execution
    still merges small ones.  The session is left as it was."""
    before = spark.conf.get(_INITIAL_PARTITIONS, None)
    spark.conf.set(_INITIAL_PARTITIONS, str(max(shuffle_partitions(spark), min(100_000, -(-(size or 0) // SHUFFLE_BYTES)))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_INITIAL_PARTITIONS)
        else:
            spark.conf.set(_INITIAL_PARTITIONS, before)


def hashed_side(df: DataFrame) -> DataFrame:
    """``df`` hinted as the build side of a shuffled hash join, which needn't
    sort (and spill) the large side.  Only when each partition of ``df`` is
    small by the session's number of partitions, and ``df`` not so small that
    it is broadcast."""
    spark = df.sparkSession
    size = estimated_size(df)
    if size is not None and broadcast_limit(spark) < size <= BUILD_BYTES * shuffle_partitions(spark):
        return df.hint("shuffle_hash")
    return df


def guarded_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Hint a broadcast only when the side is proven small.

    Beyond the limit the frame is returned unhinted: the join then plans as
    a shuffle (sort-merge) join, which AQE may still turn into a broadcast
    once it has measured the real shuffle output, and whose skewed
    partitions AQE splits."""
    limit = max_bytes if max_bytes is not None else broadcast_limit(df.sparkSession)
    size = estimated_size(df)
    if size is not None and 0 < limit and size <= limit:
        return F.broadcast(df)
    return df
