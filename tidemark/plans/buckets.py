"""A stored snapshot of which a sync rewrites only the buckets that changed.

Layout: ``<base>/data/__written=<version>/__bucket=<bucket>``, ``<base>/manifests/v00000005.json`` and ``<base>/history``. A key belongs
to one bucket by its hash. A version is its manifest, which names for each bucket the version that wrote its files; buckets without
a change share the files of an earlier version. Their rows are read as that version's NO_CHANGE rows: what else their tags say (DELETE rows
of then, the times of then) belongs to the version that wrote them. The manifest comes last, in one rename: until then a sync does
not count. Files that no kept manifest names are removed.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import HASH_COLUMN, LAST_UPDATED, OPERATION, TIMESTAMP, as_timestamp, col
from ..operators.cdc import cdc_compare, live_rows
from ..operators.history import history_changes
from ..operators.keys import dedup_by_key, keys_not_null
from ..operators.metrics import metric_columns
from ..operators.projection import Spec, project, tag_snapshot, with_row_hash
from ..session import staging
from ..sinks.files import SNAPSHOT_CODEC, rows_per_file
from ..sources.storage import entries, folders, path_exists, read_text, remove_folder, stored_size, write_text
from . import journal
from .store import compact_history, read_history, remove_history, write_history
from .sync import SyncResult, _is_earlier

WRITTEN, BUCKET = "__written", "__bucket"


@dataclass(frozen=True)
class BucketStore:
    """``count`` buckets by the hash of ``keys``: aim at a few hundred megabytes each."""

    base: str
    keys: tuple[str, ...]
    count: int = 64

    @property
    def data_path(self) -> str:
        return f"{self.base.rstrip('/')}/data"

    @property
    def history_path(self) -> str:
        return f"{self.base.rstrip('/')}/history"

    def manifest_path(self, version: int) -> str:
        return f"{self.base.rstrip('/')}/manifests/v{version:08d}.json"

    def bucket_path(self, written: int, bucket: int) -> str:
        return f"{self.data_path}/{WRITTEN}={written}/{BUCKET}={bucket}"

    def bucket(self) -> Column:
        return F.pmod(F.hash(*[col(k) for k in self.keys]), F.lit(self.count))


@dataclass(frozen=True)
class Manifest:
    version: int
    time: str
    schema: str  # of the rows, as JSON
    keys: list[str]
    count: int
    buckets: dict[int, int] = field(default_factory=dict)  # bucket to the version that wrote it
    batch: str | None = None
    result: dict[str, Any] = field(default_factory=dict)

    def paths(self, store: BucketStore) -> set[str]:
        return {store.bucket_path(written, bucket) for bucket, written in self.buckets.items()}


def versions(spark: SparkSession, store: BucketStore) -> list[int]:
    """Complete versions that are kept, oldest first."""
    folder = f"{store.base.rstrip('/')}/manifests"
    if not path_exists(spark, folder):
        return []
    found = [re.fullmatch(r"v([0-9]+)\.json", e.name) for e in entries(spark, folder)]
    return sorted(int(m[1]) for m in found if m)


def read_manifest(spark: SparkSession, store: BucketStore, version: int) -> Manifest:
    told = json.loads(read_text(spark, store.manifest_path(version)))
    return Manifest(**(told | {"buckets": {int(b): w for b, w in told["buckets"].items()}}))


def read_buckets(
    spark: SparkSession, store: BucketStore, version: int | None = None, only: Sequence[int] | None = None
) -> DataFrame | None:
    """The rows of a version (the latest if not given), or None without one. ``only`` some buckets, if given."""
    known = versions(spark, store)
    if not known:
        return None
    return _rows(spark, store, read_manifest(spark, store, version or known[-1]), only)


def _rows(spark: SparkSession, store: BucketStore, manifest: Manifest, only: Sequence[int] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(manifest.schema))
    wanted = manifest.buckets if only is None else {b: w for b, w in manifest.buckets.items() if b in set(only)}
    if not wanted:
        return spark.createDataFrame([], schema)
    paths = [store.bucket_path(w, b) for b, w in sorted(wanted.items())]
    typed = T.StructType([*schema.fields, T.StructField(WRITTEN, T.IntegerType()), T.StructField(BUCKET, T.IntegerType())])
    stored = spark.read.schema(typed).option("basePath", store.data_path).parquet(*paths)
    fresh = col(WRITTEN) == manifest.version
    operation = F.when(fresh, col(OPERATION)).otherwise("NO_CHANGE")
    moment = F.when(fresh, col(TIMESTAMP)).otherwise(as_timestamp(manifest.time))
    kept = stored.where(fresh | (col(OPERATION) != "DELETE"))
    values = {OPERATION: operation.alias(OPERATION), TIMESTAMP: moment.alias(TIMESTAMP)}
    return kept.select(*[values.get(c, col(c)) for c in schema.names])


def sync_buckets(
    source: DataFrame,
    store: BucketStore,
    now: Any,
    mappings: Sequence[Spec] | None = None,
    schema: Sequence[Spec] | None = None,
    exact: bool = False,
    order_by=None,
    batch: str | None = None,
    stale: str = "error",
    keep: int = 2,
) -> SyncResult:
    """Run one sync by key, writing only buckets with a change, and the changes into the history.

    The compare reads keys, fingerprints and times of the latest version; its other columns are read in the buckets that changed
    alone. Only changes pass through a staged copy. Rows with a NULL in the key are left out and repeated keys keep one row, also in
    the first version, whose rows are tagged SNAPSHOT. Another schema, other keys or another number of buckets rewrite all
    buckets. A sync without changes writes a manifest. ``batch`` and ``stale`` are those of ``sync.sync_table``. The latest
    ``keep`` versions remain.
    """
    if stale not in ("error", "skip"):
        raise ValueError(f"stale is 'error' or 'skip': {stale!r}")
    spark = source.sparkSession
    if batch is not None and (done := batch_result(spark, store, batch)) is not None:
        return SyncResult(**done)
    known = versions(spark, store)
    last = read_manifest(spark, store, known[-1]) if known else None
    version = last.version + 1 if last else 1
    if last and _is_earlier(spark, now, last.time):
        if stale == "error":
            raise ValueError(f"the sync's time {now} is before that of version {last.version}")
        skipped = SyncResult(last.version, {}, status="skipped")
        if batch is not None:
            journal.finish(spark, store.base, batch, asdict(skipped))
        return skipped
    if batch is not None:
        journal.begin(spark, store.base, batch, {"version": version, "now": str(now)})
    remove_folder(spark, f"{store.data_path}/{WRITTEN}={version}")  # of an earlier try

    arrived, seen, keys = Observation(), Observation(), list(store.keys)
    has_key = F.lit(True)
    for key in keys:
        has_key = has_key & col(key).isNotNull()
    projected = project(source, mappings, schema, exact)
    projected = projected.observe(arrived, F.count("*").alias("all"), F.count_if(has_key).alias("keyed"))
    hashed = with_row_hash(projected)
    with staging(spark) as stage:
        if last is None:
            rows = tag_snapshot(dedup_by_key(keys_not_null(hashed, keys), keys, order_by), now)
            row_schema, buckets = rows.schema, _write(rows.observe(seen, *metric_columns()), store, version)
        else:
            previous = live_rows(_rows(spark, store, last))
            old_schema = T.StructType.fromJson(json.loads(last.schema))
            slim = previous.select(*[col(c) for c in (*keys, HASH_COLUMN, LAST_UPDATED)])
            compared = cdc_compare(hashed, slim, keys, now, order_by)
            row_schema = compared.schema
            alike = [(f.name, f.dataType) for f in row_schema] == [(f.name, f.dataType) for f in old_schema]
            if not alike or (list(last.keys), last.count) != (keys, store.count):
                whole = cdc_compare(hashed, previous, keys, now, order_by).observe(seen, *metric_columns())
                buckets = _write(whole, store, version)
            else:
                changes = compared.observe(seen, *metric_columns()).where(col(OPERATION) != "NO_CHANGE")
                changes = stage(changes.withColumn(BUCKET, store.bucket()))
                touched = [r[0] for r in changes.select(BUCKET).distinct().collect()]  # ``count`` at most
                old = live_rows(_rows(spark, store, last, touched))
                written = _write(_merged(old, changes, keys, now).select(*[col(c) for c in row_schema.names]), store, version)
                buckets = last.buckets | written
    new = sorted(b for b, w in buckets.items() if w == version)
    told = Manifest(version, _time_text(spark, now), row_schema.json(), keys, store.count, buckets)
    if new:
        made = _rows(spark, store, told, new).where(col(OPERATION) != "NO_CHANGE")
        write_history(history_changes(made, now, unique_rows=True), store, version)
    else:
        remove_history(spark, store, version)
    counts, met = dict(seen.get), arrived.get
    counts["null_key_rows"] = met["all"] - met["keyed"]
    counts["repeated_key_rows"] = met["keyed"] - (counts["rows"] - counts["delete_rows"])
    size = sum(stored_size(spark, store.bucket_path(version, b)) for b in new)
    result = SyncResult(version, counts, size)
    final = asdict(told) | {"batch": batch, "result": asdict(result)}
    write_text(spark, store.manifest_path(version), json.dumps(final))
    if batch is not None:
        journal.finish(spark, store.base, batch, asdict(result))
    _retain(spark, store, keep)
    compact_history(spark, store, version)
    return result


def _merged(old: DataFrame, changes: DataFrame, keys: list[str], now: Any) -> DataFrame:
    """The rows of changed buckets: what was there, gone or unchanged, and what the changes bring."""
    marks = changes.select(*[col(k).alias(f"__key {k}") for k in keys], col(OPERATION).alias("__change"))
    same = F.lit(True)
    for key in keys:
        same = same & (col(key) == col(f"__key {key}"))
    met = old.join(marks, same, "left").where(col("__change").isNull() | (col("__change") == "DELETE"))
    operation = F.coalesce(col("__change"), F.lit("NO_CHANGE"))
    tags = {OPERATION: operation.alias(OPERATION), TIMESTAMP: as_timestamp(now).alias(TIMESTAMP)}
    stayed = met.select(*[tags.get(c, col(c)) for c in old.columns])
    return stayed.unionByName(changes.where(col(OPERATION) != "DELETE").drop(BUCKET))


def _write(rows: DataFrame, store: BucketStore, version: int) -> dict[int, int]:
    """Write rows by bucket, each in one task and sorted by key; tells which buckets that made."""
    spark, path = rows.sparkSession, f"{store.data_path}/{WRITTEN}={version}"
    dealt = rows.withColumn(BUCKET, store.bucket()).repartition(col(BUCKET))
    dealt = dealt.sortWithinPartitions(col(BUCKET), *[col(k) for k in store.keys])
    writer = dealt.write.mode("overwrite").option("compression", SNAPSHOT_CODEC)
    writer.option("maxRecordsPerFile", rows_per_file(len(rows.columns))).partitionBy(BUCKET).parquet(path)
    return {int(n.removeprefix(f"{BUCKET}=")): version for n in folders(spark, path) if n.startswith(f"{BUCKET}=")}


def _time_text(spark: SparkSession, now: Any) -> str:
    return spark.range(1).select(as_timestamp(now).cast("string").alias("t")).first()["t"]


def batch_result(spark: SparkSession, store: BucketStore, batch: str) -> dict[str, Any] | None:
    """The result of a job that is done, from the journal or from the version it made."""
    known = journal.outcome(spark, store.base, batch)
    if known is not None:
        return known
    for version in reversed(versions(spark, store)):
        manifest = read_manifest(spark, store, version)
        if manifest.batch == batch:
            journal.finish(spark, store.base, batch, manifest.result)
            return manifest.result
    return None


def _retain(spark: SparkSession, store: BucketStore, keep: int) -> None:
    """Remove all but the latest manifests, and the files that only those named."""
    known = versions(spark, store)
    kept = set().union(*[read_manifest(spark, store, v).paths(store) for v in known[-keep:]])
    for version in known[:-keep]:
        manifest = read_manifest(spark, store, version)
        if manifest.batch is not None:
            journal.finish(spark, store.base, manifest.batch, manifest.result)
        for path in sorted(manifest.paths(store) - kept):
            remove_folder(spark, path)
        remove_folder(spark, store.manifest_path(version))


def read_bucket_history(spark: SparkSession, store: BucketStore) -> DataFrame | None:
    """All recorded changes of complete syncs."""
    return read_history(spark, store, max(versions(spark, store), default=0))
