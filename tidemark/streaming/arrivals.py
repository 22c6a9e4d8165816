"""Syncs driven by what arrives in a folder, as Structured Streaming."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.projection import Spec
from ..plans.store import SnapshotStore
from ..plans.sync import SyncResult, sync_table
from ..sources.files import file_format, read_source

JOB_SCHEMA = "path string, format string, synced_at timestamp_ntz"
MAX_JOBS = 1000


def _utc_now(_batch_id: int) -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The stream's own name, which its checkpoint keeps over restarts."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def stream_sync(
    spark: SparkSession,
    in_dir: str,
    schema: str,
    keys: Sequence[str],
    store: SnapshotStore,
    checkpoint: str,
    clock: Callable[[int], Any] = _utc_now,
    fmt: str = "parquet",
    mappings: Sequence[Spec] | None = None,
    stream_schema: Sequence[Spec] | None = None,
) -> StreamingQuery:
    """Sync each file that arrived in ``in_dir``: a file is one complete snapshot, a key missing from it is a DELETE.

    A sync carries the name of its batch, so a batch that is done and runs again after a failure does nothing, and a stream that
    lost its checkpoint adds versions to those there are. Ends when all files present are done. For snapshots of more
    than one file use :func:`stream_jobs`.
    """

    def one_batch(rows: DataFrame, batch_id: int) -> None:
        batch = f"{_stream_id(spark, checkpoint)}-{batch_id}"
        sync_table(rows, store, keys, clock(batch_id), mappings, stream_schema, batch=batch)

    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", 1)
    if fmt == "csv":
        reader = reader.options(header=True, quote='"', escape='"')
    return (
        reader.load(in_dir)
        .writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_jobs(
    spark: SparkSession,
    in_dir: str,
    keys: Sequence[str],
    store: SnapshotStore,
    checkpoint: str,
    mappings: Sequence[Spec] | None = None,
    stream_schema: Sequence[Spec] | None = None,
    on_result: Callable[[str, SyncResult], None] | None = None,
) -> StreamingQuery:
    """Sync what each arriving job file names: a line of JSON with ``path`` (file or folder), ``format``, ``synced_at``.

    Only the job line passes through the stream; the snapshot it names is scanned by all executors, whatever its size.
    A job file holds a few jobs, which run in the order of their times. A job older than the latest snapshot would bring old
    values back; it is skipped, and told to ``on_result`` as such, like every other result. When a batch runs again, the jobs of it
    that are done do nothing and tell the results they had.
    """

    def one_batch(jobs: DataFrame, batch_id: int) -> None:
        found = jobs.where("path IS NOT NULL").take(MAX_JOBS + 1)
        if len(found) > MAX_JOBS:
            raise ValueError(f"a job file holds {MAX_JOBS} jobs at most")
        stream = _stream_id(spark, checkpoint)
        last = _utc_now(batch_id).replace(tzinfo=None)
        for k, job in enumerate(sorted(found, key=lambda j: (j["synced_at"] or last, j["path"]))):
            fmt = job["format"] or file_format(job["path"])
            # With a declared schema the casts decide the types, and inferring them would read the data twice.
            options = {"infer": False} if stream_schema and fmt == "csv" else {}
            source = read_source(spark, job["path"], fmt, **options)
            now = job["synced_at"] or last
            batch = f"{stream}-{batch_id}-{k}"
            result = sync_table(source, store, keys, now, mappings, stream_schema, batch=batch, stale="skip")
            if on_result is not None:
                on_result(job["path"], result)

    return (
        spark.readStream.schema(JOB_SCHEMA)
        .option("maxFilesPerTrigger", 1)
        .json(in_dir)
        .writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
