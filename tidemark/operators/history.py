"""Change history of a table."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import HISTORY_TIME, OPERATION, as_timestamp, col
from .cdc import changes_only


def history_changes(cdc: DataFrame, detected_at: Any, unique_rows: bool = False) -> DataFrame:
    """The rows one sync adds to the history: its changes, SNAPSHOT told as INSERT, with the time of detection.

    ``unique_rows`` promises that ``cdc`` repeats no row (a keyed compare never does) and saves the shuffle.
    """
    operation = F.when(col(OPERATION) == "SNAPSHOT", "INSERT").otherwise(col(OPERATION))
    rest = [col(c) for c in cdc.columns if c != OPERATION]
    added = changes_only(cdc).select(
        *rest, operation.alias(OPERATION), as_timestamp(detected_at).alias(HISTORY_TIME)
    )
    return added if unique_rows else added.dropDuplicates()


def append_history(
    cdc: DataFrame,
    history: DataFrame | None,
    detected_at: Any,
    distinct_history: bool = False,
    unique_rows: bool = False,
) -> DataFrame:
    """History with the changes of one sync added, every row once; columns are matched by name.

    ``distinct_history`` promises that ``history`` was built by this function. Then old rows are not touched:
    a new row can only repeat one that carries the same time of detection, and only those are compared.
    """
    if history is not None and not distinct_history:
        # Repeats among the new rows go with those of the old ones, in one shuffle.
        added = history_changes(cdc, detected_at, unique_rows=True)
        return history.unionByName(added, allowMissingColumns=True).dropDuplicates()
    added = history_changes(cdc, detected_at, unique_rows)
    if history is None:
        return added
    same_time = history.where(col(HISTORY_TIME) == as_timestamp(detected_at))
    both = history.where(~col(HISTORY_TIME).eqNullSafe(as_timestamp(detected_at)))
    replayed = same_time.unionByName(added, allowMissingColumns=True).dropDuplicates()
    return both.unionByName(replayed, allowMissingColumns=True)
