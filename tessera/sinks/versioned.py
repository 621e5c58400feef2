"""Tables that change by one atomic commit.

A table's data lies in folders that are never changed once written.  A
version is a manifest: its schema, the folders that hold its rows, and the
progress marks of the feeds that wrote it.  A change first writes its folders
(nobody reads them yet), then publishes the next manifest by one rename that
fails where that number is taken.  Readers see the old version whole or the
new one whole; a job that dies in between leaves folders that no manifest
names, and ``expire`` removes them with those of old versions.

Rows are filed in slices (one per value of a column, or one per hash bucket
of a key), so a change rewrites the slices it touches and takes the others
over by name.  The driver handles one manifest entry per slice and write,
never rows.

``reload_slices`` replaces whole slices (an idempotent day load; an empty day
becomes empty), ``append`` adds rows, ``upsert`` keeps the newest row per key.
Marks travel in the same commit as the rows, so a feed's rows and its cursor
can't part: a poll or micro-batch that is repeated after a crash finds its
mark either with its rows or without them.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.dedup import latest_per_key

SLICE = "_slice"
DELETED = "__deleted"
DELETED_IN = "__deleted_in"
BUCKET_BYTES = 256 << 20
FEW_SLICES = 64
MARKER_VERSIONS = 100


class CommitConflict(RuntimeError):
    """Another writer published the version that this commit was to be."""


@dataclass(frozen=True)
class Version:
    """A manifest.  ``slices``: name -> folders below the root with their
    bytes; ``buckets``: hash buckets of the key where it is filed by key."""
    number: int = 0
    schema: str | None = None
    slices: dict[str, list] = field(default_factory=dict)
    marks: dict = field(default_factory=dict)
    buckets: int = 0
    written_at: float = 0.0

    @property
    def bytes(self) -> int:
        return sum(size for folders in self.slices.values() for _, size in folders)


def _path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _manifest(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/_versions/{number:012d}.json"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published version numbers, ascending."""
    folder, fs = _path(spark, f"{root.rstrip('/')}/_versions")
    if not fs.exists(folder):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def load(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """A version, the newest by default; number 0 where there is none."""
    if number is None:
        number = max(versions(spark, root), default=0)
    if not number:
        return Version()
    target, fs = _path(spark, _manifest(root, number))
    stream = fs.open(target)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Version(**json.loads(text))


def commit(spark: SparkSession, root: str, version: Version) -> Version:
    """Publish ``version`` as the one after ``version.number``."""
    jvm = spark.sparkContext._jvm
    version = replace(version, number=version.number + 1, written_at=time.time())
    target, fs = _path(spark, _manifest(root, version.number))
    draft, _ = _path(spark, f"{root.rstrip('/')}/_versions/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft)
    try:
        out.write(bytearray(json.dumps(version.__dict__).encode()))
    finally:
        out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
    options[0] = getattr(jvm, "org.apache.hadoop.fs.Options$Rename").NONE
    try:
        files.rename(draft, target, options)
    except Exception as exc:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(exc):
            raise CommitConflict(f"version {version.number} of {root} is taken") from exc
        raise
    return version


def read(spark: SparkSession, root: str, version: Version | None = None, only: list[str] | None = None) -> DataFrame:
    """The rows of a version (the newest by default), of some slices only if
    those are named."""
    version = version or load(spark, root)
    if version.schema is None:
        raise FileNotFoundError(f"no version of {root}")
    schema = T.StructType.fromJson(json.loads(version.schema))
    names = version.slices if only is None else [n for n in only if n in version.slices]
    folders = [f"{root.rstrip('/')}/{folder}" for n in names for folder, _ in version.slices[n]]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def stage(df: DataFrame, root: str, by: Column, slices: int | None = None) -> dict[str, list]:
    """Write ``df`` in slices by ``by`` and return them; no reader sees them
    before a commit.  Large slices are written by several tasks.  Where
    ``slices`` says that there are few, each task files its own rows (at most
    ``slices`` files); else the rows are gathered by slice first."""
    spark, folder = df.sparkSession, f"data/{uuid.uuid4().hex}"
    rows = df.withColumn(SLICE, by)
    rows = rows if slices and slices <= FEW_SLICES else rows.hint("rebalance", SLICE)
    rows.write.option("compression", "zstd").partitionBy(SLICE).parquet(f"{root.rstrip('/')}/{folder}")
    base, fs = _path(spark, f"{root.rstrip('/')}/{folder}")
    found = {}
    for st in fs.listStatus(base):
        name = st.getPath().getName()
        if name.startswith(f"{SLICE}="):
            found[name[len(SLICE) + 1:]] = [[f"{folder}/{name}", fs.getContentSummary(st.getPath()).getLength()]]
    return found


def slice_name(spark: SparkSession, value: str) -> str:
    """The name of the slice of a value."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def _wider(old: str | None, schema: T.StructType) -> str:
    """The old schema with new columns after it; a column keeps its type."""
    if old is None:
        return schema.json()
    before = T.StructType.fromJson(json.loads(old))
    types = {f.name: f.dataType for f in before}
    for f in schema:
        if f.name in types and types[f.name].simpleString() != f.dataType.simpleString():
            raise TypeError(f"column {f.name} is {types[f.name].simpleString()}, not {f.dataType.simpleString()}")
    return T.StructType([*before.fields, *(f for f in schema if f.name not in types)]).json()


def _slice_of(by: str | Column) -> Column:
    return (F.col(by) if isinstance(by, str) else by).cast("string")


def reload_slices(df: DataFrame, root: str, by: str | Column, only: list[str] | None = None, marks: dict | None = None,
                  slices: int | None = None) -> Version:
    """Replace the slices by ``by`` (a column) that ``df`` holds, and empty those
    named in ``only`` that it doesn't.  The first load makes the table.
    ``slices``: how many ``df`` holds, if known (``stage``)."""
    spark = df.sparkSession
    base = load(spark, root)
    new = stage(df, root, _slice_of(by), slices)
    gone = {slice_name(spark, v) for v in only or ()}
    kept = {n: f for n, f in base.slices.items() if n not in gone}
    return commit(spark, root, replace(base, schema=_wider(base.schema, df.schema), slices=kept | new, marks=base.marks | (marks or {})))


def append(df: DataFrame, root: str, by: str | Column, marks: dict | None = None, slices: int | None = None) -> Version:
    """Add the rows of ``df`` together with the feed's marks (``slices``: as
    for ``reload_slices``)."""
    base = load(df.sparkSession, root)
    new = stage(df, root, _slice_of(by), slices)
    merged = base.slices | {n: [*base.slices.get(n, []), *folders] for n, folders in new.items()}
    return commit(df.sparkSession, root, replace(base, schema=_wider(base.schema, df.schema), slices=merged, marks=base.marks | (marks or {})))


def bucket(keys: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("string")


def stage_upsert(batch: DataFrame, root: str, keys: list[str], order_by: list[str], op_col: str | None = None,
                 bucket_bytes: int = BUCKET_BYTES, marker_versions: int = MARKER_VERSIONS) -> Version:
    """Write the buckets that ``batch`` touches, each with the newest row per
    key of its old rows and the batch, and return the version to commit.

    The number of buckets follows the table's bytes: a power of two that
    keeps a bucket near ``bucket_bytes``; when it has to grow, all buckets
    are rewritten once.  With ``op_col``, a key whose newest change is 'd'
    stays as a marked row, so that an older change that comes late can't
    bring it back, for ``marker_versions`` versions."""
    spark, base = batch.sparkSession, load(batch.sparkSession, root)
    deleted = F.coalesce(F.col(op_col) == "d", F.lit(False)) if op_col else F.lit(False)
    rows = batch.withColumns({DELETED: deleted, DELETED_IN: F.lit(base.number + 1)})
    changes = latest_per_key(rows.drop(op_col) if op_col else rows, keys, order_by).persist()
    try:
        wanted = 1
        while wanted * bucket_bytes < base.bytes:
            wanted *= 2
        buckets = max(wanted, base.buckets)
        if base.schema is None:
            old, kept = None, {}
        elif buckets > base.buckets:
            old, kept = read(spark, root, base), {}
        else:
            touched = [r[0] for r in changes.select(bucket(keys, buckets)).distinct().collect()]  # at most ``buckets``
            old = read(spark, root, base, touched)
            kept = {n: f for n, f in base.slices.items() if n not in touched}
        if old is None:
            merged = changes
        else:
            forgotten = F.col(DELETED) & (F.col(DELETED_IN) <= base.number - marker_versions)
            merged = latest_per_key(old.unionByName(changes, allowMissingColumns=True), keys, order_by).where(~forgotten)
        new = stage(merged, root, bucket(keys, buckets), buckets)
        return replace(base, schema=_wider(base.schema, merged.schema), slices=kept | new, buckets=buckets)
    finally:
        changes.unpersist()


def upsert(batch: DataFrame, root: str, keys: list[str], order_by: list[str], op_col: str | None = None,
           mark: tuple[str, int] | None = None, **how) -> Version:
    """Upsert ``batch`` and commit.  ``mark`` (feed, batch number) makes a
    repeated batch do nothing."""
    spark = batch.sparkSession
    base = load(spark, root)
    if mark and base.marks.get(mark[0], -1) >= mark[1]:
        return base
    ready = stage_upsert(batch, root, keys, order_by, op_col, **how)
    return commit(spark, root, replace(ready, marks=ready.marks | dict([mark] if mark else [])))


def live(df: DataFrame) -> DataFrame:
    """The rows of an upsert table that aren't marked as deleted."""
    return df.where(~F.col(DELETED)).drop(DELETED, DELETED_IN)


def expire(spark: SparkSession, root: str, keep: int = 3, idle_seconds: float = 86_400.0) -> int:
    """Drop all versions but the newest ``keep``, and folders that no kept
    version names.  Folders younger than ``idle_seconds`` stay, since a
    writer may be about to commit them.  Returns the folders removed."""
    numbers = versions(spark, root)
    named = set()
    for n in numbers[-keep:]:
        named |= {folder.split("/")[1] for folders in load(spark, root, n).slices.values() for folder, _ in folders}
    for n in numbers[:-keep]:
        target, fs = _path(spark, _manifest(root, n))
        fs.delete(target, False)
    base, fs = _path(spark, f"{root.rstrip('/')}/data")
    removed = 0
    for st in fs.listStatus(base) if fs.exists(base) else []:
        if st.getPath().getName() not in named and st.getModificationTime() / 1000 <= time.time() - idle_seconds:
            removed += bool(fs.delete(st.getPath(), True))
    return removed
