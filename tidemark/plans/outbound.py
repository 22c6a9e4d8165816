"""Export of a snapshot to a target."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass
from typing import Any
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import HASH_COLUMN
from ..operators.changelog import build_changelog
from ..operators.export import prepare_export
from ..operators.keys import dedup_by_key
from ..operators.merge import CHANGE, append, reconcile, reload, upsert
from ..session import staging
from ..sinks.files import CHANGELOG_CODEC, write_csv, write_parquet
from ..sinks.jdbc import append_jdbc, replace_jdbc
from ..sources.storage import stored_size
from . import journal, tiers
from .store import SnapshotStore, Version, batch_result, mark_batch, publish_snapshot, read_version, versions
from .sync import SyncResult

# The operation names the changelog carries per plan. A reconciled row carries its own.
PLAN_OPERATIONS = {"append": "INSERT", "upsert": "UPSERT", "reload": "TRUNCATE_RELOAD", "reconcile": None}
# End of fixed values.

JOB_FOLDER = "__job"


@dataclass(frozen=True)
class WritePlan:
    action: str  # append, upsert, reconcile or reload
    keys: tuple[str, ...] = ()
    clear_first: bool = False

    @property
    def operation(self) -> str | None:
        return PLAN_OPERATIONS[self.action]


@dataclass(frozen=True)
class Export:
    """New content of the target, the rows that were written, and the entries for the changelog."""

    target: DataFrame
    written: DataFrame
    changelog: DataFrame


def write_plan(config: Mapping[str, Any], target_kind: str) -> WritePlan:
    """How to write, from the target's settings: keys are ``primaryKey``, else ``upsertKeys``."""
    if target_kind not in ("postgres", "mysql"):
        raise ValueError(f"unsupported target: {target_kind!r}")
    keys = tuple(config.get("primaryKey") or config.get("upsertKeys") or ())
    clear = bool(config.get("truncateFirst"))
    if not keys:
        return WritePlan("append", (), clear)
    if target_kind == "postgres":
        return WritePlan("upsert", keys, clear)
    return WritePlan("reload", keys, True) if clear else WritePlan("reconcile", keys)


def run_plan(
    plan: WritePlan,
    target: DataFrame | None,
    source: DataFrame,
    now: Any,
    job_id: str | None = None,
    order_by=None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> Export:
    """Work out an export without writing it. ``source`` comes from :func:`prepare_export`; ``target`` is None if new.

    The fingerprint of ``source``, if it has one, only helps to choose between rows of one key.
    """
    if target is None:
        target = source.drop(HASH_COLUMN).limit(0)
    base = target.limit(0) if plan.clear_first else target
    if plan.action == "append":
        written, result = source, append(base, source)
    elif plan.action == "upsert":
        written, result = dedup_by_key(source, plan.keys, order_by), upsert(base, source, plan.keys, order_by)
    elif plan.action == "reload":
        written = reload(source, plan.keys, order_by)
        result = append(base, written)
    else:
        result, written = reconcile(base, source, plan.keys, order_by, stage=stage)
    return Export(result, written.drop(HASH_COLUMN), build_changelog(written, now, job_id, plan.operation))


def export_to_jdbc(
    snapshot: DataFrame,
    options: dict[str, str],
    plan: WritePlan,
    now: Any,
    job_id: str | None = None,
    target: DataFrame | None = None,
    target_schema=None,
    changelog_path: str | None = None,
    **prepare,
) -> None:
    """Clean, write by plan, and add to the changelog.

    ``target`` is the scan of the target table, None if it is to be created. Rows to write are worked out before the
    target changes: the changelog must not be computed from the target after the write.
    """
    source = prepare_export(snapshot, target_schema or (target.schema if target is not None else None), **prepare)
    export = run_plan(plan, target, source, now, job_id)
    with staging(snapshot.sparkSession) as stage:
        entries = stage(export.changelog) if changelog_path else None
        if plan.action == "append" and not plan.clear_first:
            append_jdbc(export.written.drop(CHANGE), options)
        else:
            replace_jdbc(export.target, options)
        if entries is not None:
            append_changelog(entries, changelog_path, job_id)


def export_to_store(
    snapshot: DataFrame,
    store: SnapshotStore,
    plan: WritePlan,
    now: Any,
    job_id: str,
    target_schema=None,
    changelog_path: str | None = None,
    order_by=None,
    **prepare,
) -> SyncResult:
    """Clean, write by plan into a stored Parquet table, and record the changelog of the job: one commit.

    The table is a version of ``store`` without tags. A job that failed half-way is run again under its id: its version did
    not count, and its changelog is replaced. A job that is done is not: running it again changes neither table nor changelog and
    gives the result it had.
    """
    spark = snapshot.sparkSession
    if (done := batch_result(spark, store, job_id)) is not None:
        return SyncResult(**done)
    before = versions(spark, store)
    version = before[-1].number + 1 if before else 1
    journal.begin(spark, store.base, job_id, {"version": version, "now": str(now)})
    target = read_version(spark, store, before[-1]) if before else None
    seen = Observation()
    with staging(spark) as stage:
        schema = target_schema or (target.schema if target is not None else None)
        source = stage(prepare_export(snapshot, schema, **prepare))
        export = run_plan(plan, target, source, now, job_id, order_by, stage)

        def record(written: Version) -> None:
            if changelog_path:
                append_changelog(export.changelog, changelog_path, job_id)
            size = stored_size(spark, store.version_path(*written))
            mark_batch(spark, store, written, job_id, asdict(SyncResult(version, dict(seen.get), size)))

        observed = export.target.observe(seen, F.count("*").alias("rows"))
        publish_snapshot(observed, store, version, before_commit=record)
    result = SyncResult(**batch_result(spark, store, job_id))
    if changelog_path:
        compact_changelog(spark, changelog_path, lambda job: journal.outcome(spark, store.base, job) is not None)
    return result


def export_to_csv(
    snapshot: DataFrame,
    config: Mapping[str, Any],
    now: Any,
    model_name: str = "export",
    header: bool = True,
    delimiter: str = ",",
) -> tuple[str, int]:
    """Write a whole snapshot, system columns included, as the settings of a file target say.

    ``config`` has ``remotePath``, ``fileName``, ``overwriteExisting`` and ``archiveAfterUpload``. Returns where it went and
    the number of rows, counted while they were written.
    """
    if config.get("overwriteExisting"):
        if_exists = "overwrite"
    else:
        if_exists = "archive" if config.get("archiveAfterUpload") else "error"
    seen = Observation()
    rows = snapshot.observe(seen, F.count("*").alias("rows"))
    path = write_csv(
        rows, config["remotePath"], config.get("fileName"), header, delimiter, if_exists, now, model_name
    )
    return path, seen.get["rows"]


def append_changelog(entries: DataFrame, path: str, job_id: str | None = None) -> None:
    """Add the entries of a job to a stored changelog; other jobs' files are not touched.

    A job has a folder of its own, so a job that runs again replaces its entries. Without an id they are added as they are.
    """
    folder = f"{path.rstrip('/')}/{JOB_FOLDER}={quote(job_id or 'unnamed', safe='')}"
    write_parquet(entries, folder, codec=CHANGELOG_CODEC, mode="overwrite" if job_id else "append")


def compact_changelog(spark: SparkSession, path: str, done: Callable[[str], bool]) -> int:
    """Merge the entries of jobs that are done and so will not write them again; see ``plans.tiers``."""

    def final(folder: str) -> bool:
        return done(unquote(folder.removeprefix(f"{JOB_FOLDER}=")))

    return tiers.compact(spark, path, final, CHANGELOG_CODEC)


def read_changelog(spark: SparkSession, path: str) -> DataFrame:
    """The entries of all jobs; a column that some lack is NULL there."""
    return spark.read.option("mergeSchema", True).parquet(*(tiers.readable(spark, path) or [path])).drop(JOB_FOLDER)
