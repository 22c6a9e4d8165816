"""Versions of a snapshot on storage, and its history.

Layout: ``<base>/v00000001`` (``-b<count>-<digest of the keys>`` appended when bucketed) and
``<base>/history/sync=00000001`` (merged in tiers, see ``plans.tiers``). A version counts
once its ``_SUCCESS`` marker is there, which is created last of all, after the sync's history: a job that dies half-way
leaves the earlier version in place, and history beyond the latest complete version does not count. The latest two are kept.
A version that a job made carries a ``_batch-<job>`` file with the job's result. When it is removed, the journal has the result.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from hashlib import md5
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions import TIMESTAMP, col, quote
from ..session import overridden
from ..sinks.files import MARKS_SUCCESS, SNAPSHOT_CODEC, rows_per_file, write_parquet
from ..sources.storage import entries, folders, path_exists, read_text, remove_folder, touch, write_text
from . import journal, tiers


@dataclass(frozen=True)
class Buckets:
    """Store compared snapshots bucketed and sorted by ``keys``: comparing with them needs no shuffle of them.

    ``count`` is also the number of shuffle partitions of the compare: aim at a few hundred megabytes per bucket.
    Only compared snapshots are unique by key; the plain first one, where a key may repeat, is not bucketed.
    """

    keys: tuple[str, ...]
    count: int

    @property
    def layout(self) -> str:
        return f"b{self.count}-{md5(','.join(self.keys).encode()).hexdigest()[:8]}"


@dataclass(frozen=True)
class SnapshotStore:
    base: str
    buckets: Buckets | None = None

    @property
    def history_path(self) -> str:
        return f"{self.base.rstrip('/')}/history"

    def version_path(self, version: int, layout: str = "") -> str:
        return f"{self.base.rstrip('/')}/v{version:08d}" + (f"-{layout}" if layout else "")


class Version(NamedTuple):
    number: int
    layout: str  # empty when not bucketed


def versions(spark: SparkSession, store: SnapshotStore) -> list[Version]:
    """Complete versions, oldest first."""
    found = []
    for name in folders(spark, store.base):
        match = re.fullmatch(r"v([0-9]+)(?:-(b[0-9]+-[0-9a-f]+))?", name)
        if match and path_exists(spark, f"{store.base.rstrip('/')}/{name}/_SUCCESS"):
            found.append(Version(int(match[1]), match[2] or ""))
    return sorted(found)


def next_version(spark: SparkSession, store: SnapshotStore) -> int:
    return max((v.number for v in versions(spark, store)), default=0) + 1


def publish_snapshot(
    df: DataFrame,
    store: SnapshotStore,
    version: int,
    unique: bool = False,
    keep: int = 2,
    before_commit: Callable[[Version], None] | None = None,
) -> Version:
    """Write ``df`` as ``version``; afterwards only the latest ``keep`` versions remain.

    ``df`` may be computed from earlier versions: it never writes where it reads. Writing the same version again
    replaces it. ``unique`` says that no key repeats, which bucketing needs. ``before_commit`` runs when all rows are
    written and before the version counts.
    """
    spark = df.sparkSession
    written = Version(version, store.buckets.layout if store.buckets and unique else "")
    path = store.version_path(*written)
    if written.layout:
        name = _table_name()
        with _aligned(spark, store):
            (
                df.write.mode("overwrite")
                .option("compression", SNAPSHOT_CODEC)
                .option(MARKS_SUCCESS, "false")
                .option("maxRecordsPerFile", rows_per_file(len(df.columns)))
                .option("path", path)
                .bucketBy(store.buckets.count, *store.buckets.keys)
                .sortBy(*store.buckets.keys)
                .saveAsTable(name)
            )
        spark.sql(f"DROP TABLE {name}")  # external: the files stay
    else:
        write_parquet(df, path, mode="overwrite", marked=False)
    if before_commit is not None:
        before_commit(written)
    touch(spark, f"{path}/_SUCCESS")
    known = versions(spark, store)
    numbers = sorted({v.number for v in known if v.number <= version})[-keep:]
    for old in known:
        if old.number < numbers[0] or (old.number == version and old != written):
            _enter_jobs(spark, store, old)
            remove_folder(spark, store.version_path(*old))
    return written


def mark_batch(spark: SparkSession, store: SnapshotStore, version: Version, batch: str, result: Mapping[str, Any]) -> None:
    """Note which job made a version, and what it did."""
    write_text(spark, f"{store.version_path(*version)}/{_mark(batch)}", json.dumps({"batch": batch, "result": dict(result)}))


def _mark(batch: str) -> str:
    return f"_batch-{journal.job_name(batch)}"


def batch_result(spark: SparkSession, store: SnapshotStore, batch: str) -> dict[str, Any] | None:
    """The result of a job that is done, from the journal or from the version it made."""
    known = journal.outcome(spark, store.base, batch)
    if known is not None:
        return known
    for version in reversed(versions(spark, store)):
        text = read_text(spark, f"{store.version_path(*version)}/{_mark(batch)}")
        if text:
            result = json.loads(text)["result"]
            journal.finish(spark, store.base, batch, result)
            return result
    return None


def _enter_jobs(spark: SparkSession, store: SnapshotStore, version: Version) -> None:
    """Before a version goes: have its jobs in the journal."""
    path = store.version_path(*version)
    for entry in entries(spark, path):
        text = read_text(spark, f"{path}/{entry.name}") if entry.name.startswith("_batch-") else None
        if text:
            told = json.loads(text)
            journal.finish(spark, store.base, told["batch"], told["result"])


def version_time(spark: SparkSession, store: SnapshotStore, version: Version) -> Any:
    """When a version was synced, by its rows; None if it has none."""
    row = spark.read.parquet(store.version_path(*version)).select(quote(TIMESTAMP)).first()
    return row[0] if row else None


def read_snapshot(spark: SparkSession, store: SnapshotStore, before: int | None = None) -> DataFrame | None:
    """The latest version (older than ``before`` if given), or None."""
    known = [v for v in versions(spark, store) if before is None or v.number < before]
    return read_version(spark, store, known[-1]) if known else None


def read_version(spark: SparkSession, store: SnapshotStore, version: Version) -> DataFrame:
    path = store.version_path(*version)
    rows = spark.read.parquet(path)
    if store.buckets is None or version.layout != store.buckets.layout:
        return rows  # files of any layout are read whole, only without the promise of buckets
    keys = ", ".join(quote(k) for k in store.buckets.keys)
    name, location = _table_name(), path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({rows.schema.toDDL()}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
        f"INTO {store.buckets.count} BUCKETS LOCATION '{location}'"
    )
    bucketed = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return bucketed


def write_history(changes: DataFrame, store: SnapshotStore, version: int) -> None:
    """Add the changes of one sync. Each sync has its own folder, so repeating a sync replaces its rows."""
    write_parquet(changes, f"{store.history_path}/sync={version:08d}", mode="overwrite")


def remove_history(spark: SparkSession, store: SnapshotStore, version: int) -> None:
    """Take back what an earlier try of the same sync recorded."""
    remove_folder(spark, f"{store.history_path}/sync={version:08d}")


def read_history(spark: SparkSession, store: SnapshotStore, latest: int | None = None) -> DataFrame | None:
    """All recorded changes of complete syncs; columns that came later are NULL in earlier rows.

    Each sync keeps the types it was written with. A column whose type changed comes in the widest of its types if all are
    numbers, else as text, so that no value is lost. ``latest`` is the latest complete version, if the caller knows it.
    """
    if latest is None:
        latest = max((v.number for v in versions(spark, store)), default=0)
    paths = tiers.readable(spark, store.history_path, lambda name: sync_number(name) <= latest)
    if not paths:
        return None
    by_schema = tiers.by_schema(spark, paths)
    types: dict[str, T.DataType] = {}
    for schema in by_schema:
        for field in schema.fields:
            known = types.get(field.name, field.dataType)
            types[field.name] = known if known == field.dataType else _common_type(known, field.dataType)
    parts = [
        spark.read.schema(schema).parquet(*paths).select(*[col(f.name).cast(types[f.name]).alias(f.name) for f in schema.fields])
        for schema, paths in by_schema.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def sync_number(name: str) -> int:
    return int(name.removeprefix("sync="))


def compact_history(spark: SparkSession, store: SnapshotStore, latest: int) -> int:
    """Merge the history of syncs before the ``latest``, which alone may still be written again; see ``plans.tiers``."""
    return tiers.compact(spark, store.history_path, lambda name: sync_number(name) < latest, SNAPSHOT_CODEC)


def _common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds every value of both: the wider of two whole numbers, else text."""
    whole = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
    if a in whole and b in whole:
        return max(a, b, key=whole.index)
    if {a, b} == {T.FloatType(), T.DoubleType()}:
        return T.DoubleType()
    return T.StringType()


@contextmanager
def _aligned(spark: SparkSession, store: SnapshotStore) -> Iterator[None]:
    """Shuffle by key into as many partitions as there are buckets, so that each task holds whole buckets."""
    with overridden(
        spark,
        spark__sql__shuffle__partitions=store.buckets.count,
        spark__sql__adaptive__coalescePartitions__initialPartitionNum=store.buckets.count,
    ):
        yield


def _table_name() -> str:
    return f"tidemark_{uuid.uuid4().hex}"
