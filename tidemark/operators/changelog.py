"""Log of the rows an export wrote."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import CHANGELOG_COLUMNS, HASH_COLUMN, TAG_COLUMNS, col
from .merge import CHANGE


def build_changelog(changes: DataFrame, now: Any, job_id: str | None, operation: str | Column | None = None) -> DataFrame:
    """Exported columns with operation, time (text), job and row type; the latter is always ``new``.

    ``operation`` defaults to the one :func:`~tidemark.operators.merge.merge_changes` left in the rows.
    """
    if operation is None:
        operation = col(CHANGE)
    elif isinstance(operation, str):
        operation = F.lit(operation)
    kept = [c for c in changes.columns if c not in (CHANGE, HASH_COLUMN, *TAG_COLUMNS)]
    values = (operation, F.lit(_iso_text(now)), F.lit(job_id or "unknown"), F.lit("new"))
    return changes.select(
        *[col(c) for c in kept], *[v.cast("string").alias(name) for v, name in zip(values, CHANGELOG_COLUMNS)]
    )


def merge_changelog(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Old entries and new ones, columns matched by name."""
    return new if old is None else old.unionByName(new, allowMissingColumns=True)


def _iso_text(now: Any) -> str:
    if isinstance(now, str):
        now = dt.datetime.fromisoformat(now)
    if now.tzinfo:
        now = now.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return now.isoformat(timespec="milliseconds") + "Z"
