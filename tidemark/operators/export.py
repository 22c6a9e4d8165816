"""Preparing a snapshot for a target: columns, dates, NULL rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import HASH_COLUMN, TAG_COLUMNS, col, is_internal_column
from .cdc import live_rows
from .projection import with_row_hash

# Fixed value: the earliest date that is exported, and its stand-in where the target wants a date.
EARLIEST_DATE = dt.date(1900, 1, 1)
# End of fixed values.

_DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _nullable(target_schema: T.StructType | None) -> dict[str, bool]:
    return {f.name.lower(): f.nullable for f in target_schema.fields} if target_schema else {}


def drop_system_columns(df: DataFrame, drop_numbered: bool = True) -> DataFrame:
    """Without internal columns; the tags and the fingerprint stay."""
    return df.select(*[col(c) for c in df.columns if not is_internal_column(c, drop_numbered)])


def export_columns(df: DataFrame, target_schema: T.StructType | None = None) -> DataFrame:
    """Without fingerprint and tags, and only what the target has (any letter case) if it exists."""
    kept = [c for c in df.columns if c != HASH_COLUMN and c not in TAG_COLUMNS]
    if target_schema is not None:
        wanted = _nullable(target_schema)
        kept = [c for c in kept if c.lower() in wanted]
    return df.select(*[col(c) for c in kept])


def _clean_date(value: Column, data_type: T.DataType, nullable: bool) -> Column:
    # Every empty date (NULL, year 0, year 1) lies before the earliest one.
    kept = F.when(value >= F.lit(EARLIEST_DATE).cast(data_type), value)
    return kept if nullable else kept.otherwise(F.lit(EARLIEST_DATE).cast(data_type))


def clean_dates(df: DataFrame, target_schema: T.StructType | None = None) -> DataFrame:
    """Missing, empty and too early dates: NULL, or the earliest date where the target is NOT NULL."""
    nullable = _nullable(target_schema)
    return df.select(
        *[
            _clean_date(col(f.name), f.dataType, nullable.get(f.name.lower(), True)).alias(f.name)
            if isinstance(f.dataType, _DATES)
            else col(f.name)
            for f in df.schema.fields
        ]
    )


def fill_not_null(df: DataFrame, target_schema: T.StructType | None = None) -> DataFrame:
    """NULL text becomes empty and NULL numbers become 0 where the target is NOT NULL."""
    nullable = _nullable(target_schema)

    def filled(field: T.StructField) -> Column:
        value = col(field.name)
        if nullable.get(field.name.lower(), True):
            return value
        if isinstance(field.dataType, (T.StringType, T.CharType, T.VarcharType)):
            return F.coalesce(value, F.lit(""))
        if isinstance(field.dataType, T.NumericType):
            return F.coalesce(value, F.lit(0).cast(field.dataType))
        return value

    return df.select(*[filled(f).alias(f.name) for f in df.schema.fields])


def prepare_export(
    df: DataFrame,
    target_schema: T.StructType | None = None,
    drop_numbered: bool = True,
    live_only: bool = False,
) -> DataFrame:
    """A snapshot as the target gets it, with the fingerprint taken over the cleaned values if it had one."""
    had_hash = HASH_COLUMN in df.columns
    if live_only:
        df = live_rows(df)
    out = export_columns(drop_system_columns(df, drop_numbered), target_schema)
    out = fill_not_null(clean_dates(out, target_schema), target_schema)
    return with_row_hash(out, out.columns) if had_hash else out
