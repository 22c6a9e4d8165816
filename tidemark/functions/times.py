"""The clock is always an argument, so that a rerun gives the same rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_timestamp(moment: dt.datetime | str | Column) -> Column:
    """``moment`` as a timestamp without zone; zoned datetimes are taken to UTC first."""
    if isinstance(moment, Column):
        return moment.cast("timestamp_ntz")
    if isinstance(moment, dt.datetime):
        if moment.tzinfo:
            moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
        moment = moment.isoformat(sep=" ")
    return F.lit(moment).cast("timestamp_ntz")
