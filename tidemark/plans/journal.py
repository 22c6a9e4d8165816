"""What became of each job on a stored table: kept for good, while versions come and go.

``<base>/jobs/<job>.started`` is written when a job begins, ``<base>/jobs/<job>.done`` with its result once its version is complete. A
version's own mark holds the result too, from before it is complete; so a job that died between its version and its entry is
told as done. A job that is done is never run again: it gives the result it had, whatever happened to the table since.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from hashlib import sha256
from typing import Any
from urllib.parse import quote

from pyspark.sql import SparkSession

from ..sources.storage import read_text, write_text

_LONGEST = 120


def job_name(job: str) -> str:
    """A job's id as a file name."""
    name = quote(job, safe="").replace(".", "%2E")
    return name if len(name) <= _LONGEST else f"{name[:40]}-{sha256(job.encode()).hexdigest()}"


def _path(base: str, job: str, state: str) -> str:
    return f"{base.rstrip('/')}/jobs/{job_name(job)}.{state}"


def begin(spark: SparkSession, base: str, job: str, intent: Mapping[str, Any]) -> None:
    """Note what a job is about to do; its first try counts."""
    write_text(spark, _path(base, job, "started"), json.dumps(dict(intent) | {"job": job}))


def finish(spark: SparkSession, base: str, job: str, result: Mapping[str, Any]) -> None:
    """Note a job's result, once."""
    write_text(spark, _path(base, job, "done"), json.dumps(dict(result) | {"job": job}))


def outcome(spark: SparkSession, base: str, job: str) -> dict[str, Any] | None:
    """The result of a finished job, else None."""
    text = read_text(spark, _path(base, job, "done"))
    return None if text is None else {k: v for k, v in json.loads(text).items() if k != "job"}


def intent(spark: SparkSession, base: str, job: str) -> dict[str, Any] | None:
    """What a job set out to do, else None."""
    text = read_text(spark, _path(base, job, "started"))
    return None if text is None else {k: v for k, v in json.loads(text).items() if k != "job"}
