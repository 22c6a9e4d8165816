"""Inbound sync of one table: scan result to snapshot version and change history."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import as_timestamp, col
from ..operators.cdc import cdc_compare, live_rows
from ..operators.history import history_changes
from ..operators.metrics import metric_columns
from ..operators.projection import Spec, project, tag_snapshot, with_row_hash
from ..sources.storage import stored_size
from . import journal
from .store import (
    SnapshotStore,
    Version,
    batch_result,
    compact_history,
    mark_batch,
    publish_snapshot,
    read_version,
    remove_history,
    version_time,
    versions,
    write_history,
)


@dataclass(frozen=True)
class SyncResult:
    """What a sync did. ``counts`` has the rows of the snapshot, in all and per operation, and ``null_key_rows`` and
    ``repeated_key_rows`` of the source, which a keyed compare leaves out; ``bytes`` is what the version takes on storage."""

    version: int
    counts: dict[str, int]
    bytes: int = 0
    status: str = "completed"  # or "skipped"


def synced_rows(
    source: DataFrame,
    previous: DataFrame | None,
    keys: Sequence[str],
    now: Any,
    mappings: Sequence[Spec] | None = None,
    schema: Sequence[Spec] | None = None,
    exact: bool = False,
    order_by=None,
) -> DataFrame:
    """The new snapshot: compared by key with the live rows of the previous one, or plain without key or previous."""
    hashed = with_row_hash(project(source, mappings, schema, exact))
    if keys and previous is not None:
        return cdc_compare(hashed, live_rows(previous), keys, now, order_by)
    return tag_snapshot(hashed, now)


def left_out_rows(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows a keyed compare leaves out: with NULL in the key, and repeats of a key."""
    has_key = F.lit(True)
    for key in keys:
        has_key = has_key & col(key).isNotNull()
    per_key = source.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias("n"))
    null_rows = F.coalesce(F.sum(F.when(~has_key, col("n"))), F.lit(0))
    repeats = F.coalesce(F.sum(F.when(has_key, col("n") - 1)), F.lit(0))
    return per_key.agg(null_rows.alias("null_key_rows"), repeats.alias("repeated_key_rows"))


def sync_table(
    source: DataFrame,
    store: SnapshotStore,
    keys: Sequence[str],
    now: Any,
    mappings: Sequence[Spec] | None = None,
    schema: Sequence[Spec] | None = None,
    exact: bool = False,
    order_by=None,
    version: int | None = None,
    batch: str | None = None,
    stale: str = "error",
) -> SyncResult:
    """Run one sync: write the snapshot as the next version and its changes to the history, then complete the version.

    Snapshot, history and marker are one commit: until the version is complete, neither its rows nor its changes count, and
    a sync that failed half-way is simply run again. The compare runs once: counts are observed during the write, and the
    history is taken from the written version.

    ``batch`` names the sync (a stream's batch, say). Once it is done, running it again does nothing and gives the result it had,
    also when later syncs have replaced its version. ``version`` replaces a version by number; one below the latest is an error. So is a ``now`` before the latest version's, unless it is that version's
    own repeat; with ``stale="skip"`` nothing is written then and the status says so.
    """
    if stale not in ("error", "skip"):
        raise ValueError(f"stale is 'error' or 'skip': {stale!r}")
    spark = source.sparkSession
    if batch is not None and (done := batch_result(spark, store, batch)) is not None:
        return SyncResult(**done)
    known = versions(spark, store)
    latest = known[-1].number if known else 0
    version = version or latest + 1
    if version < latest:
        raise ValueError(f"version {version} is below the latest, {latest}")
    before = [v for v in known if v.number < version]
    if before and _is_earlier(spark, now, version_time(spark, store, before[-1])):
        if stale == "skip":
            skipped = SyncResult(latest, {}, status="skipped")
            if batch is not None:
                journal.finish(spark, store.base, batch, asdict(skipped))
            return skipped
        raise ValueError(f"the sync's time {now} is before that of version {before[-1].number}")
    if batch is not None:
        journal.begin(spark, store.base, batch, {"version": version, "now": str(now)})
    previous = read_version(spark, store, before[-1]) if before else None
    compared = bool(keys) and previous is not None
    projected, arrived = project(source, mappings, schema, exact), Observation()
    if compared:
        has_key = reduce(and_, [col(k).isNotNull() for k in keys])
        projected = projected.observe(arrived, F.count("*").alias("all"), F.count_if(has_key).alias("keyed"))
    rows, seen = synced_rows(projected, previous, keys, now, exact=True, order_by=order_by), Observation()

    def record(written: Version) -> None:
        changed = seen.get["rows"] > seen.get["no_change_rows"]
        if keys and changed:
            added = spark.read.parquet(store.version_path(*written))
            write_history(history_changes(added, now, unique_rows=compared), store, version)
        else:
            remove_history(spark, store, version)
        if batch is not None:
            mark_batch(spark, store, written, batch, asdict(told(written)))

    def told(written: Version) -> SyncResult:
        counts = dict(seen.get) | {"null_key_rows": 0, "repeated_key_rows": 0}
        if compared:
            met = arrived.get
            counts["null_key_rows"] = met["all"] - met["keyed"]
            counts["repeated_key_rows"] = met["keyed"] - (counts["rows"] - counts["delete_rows"])
        return SyncResult(version, counts, stored_size(spark, store.version_path(*written)))

    observed = rows.observe(seen, *metric_columns())
    result = told(publish_snapshot(observed, store, version, unique=compared, before_commit=record))
    compact_history(spark, store, version)
    if batch is not None:
        result = SyncResult(**batch_result(spark, store, batch))
    return result


def _is_earlier(spark: SparkSession, now: Any, then: Any) -> bool:
    """Whether ``now`` is before ``then``, both as the engine stores times."""
    if then is None:
        return False
    moment = spark.range(1).select((as_timestamp(now) < as_timestamp(then)).alias("earlier"))
    return bool(moment.first()["earlier"])
