"""Refresh of a derived model."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession

from ..operators.cdc import first_refresh, hash_cdc, live_rows
from ..operators.metrics import metric_columns
from ..operators.models import Definition, build_model
from ..operators.projection import with_row_hash
from ..session import staging
from ..sources.storage import stored_size
from .store import SnapshotStore, publish_snapshot, read_version, versions
from .sync import SyncResult


def refresh_model(
    spark: SparkSession,
    definition: Definition,
    models: Mapping[str, DataFrame],
    previous: DataFrame | None = None,
    now: Any = None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
    double_quoted_identifiers: bool = False,
) -> DataFrame:
    """The tagged rows of a derived model, compared by fingerprint with its previous version.

    The compare reads the model's result twice. Shuffles inside the model are reused; ``stage`` (see
    :func:`~tidemark.session.staging`) writes a costly result first, so that it is computed once.
    """
    current = with_row_hash(build_model(spark, definition, models, double_quoted_identifiers))
    if previous is None:
        return first_refresh(current, now)
    return hash_cdc(stage(current) if stage else current, live_rows(previous), now)


def refresh_table(
    spark: SparkSession,
    definition: Definition,
    models: Mapping[str, DataFrame],
    store: SnapshotStore,
    now: Any,
    stage: bool = True,
    double_quoted_identifiers: bool = False,
) -> SyncResult:
    """Refresh a stored model: the new version, its counts and its size. ``stage`` computes the model's result once; the
    copy is removed when the version is there, or when the refresh failed."""
    before = versions(spark, store)
    version = before[-1].number + 1 if before else 1
    previous = read_version(spark, store, before[-1]) if before else None
    seen = Observation()
    with staging(spark) as write:
        rows = refresh_model(spark, definition, models, previous, now, write if stage else None, double_quoted_identifiers)
        written = publish_snapshot(rows.observe(seen, *metric_columns()), store, version)
    return SyncResult(version, dict(seen.get), stored_size(spark, store.version_path(*written)))
