"""Writing tables as files."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import col, expand_file_name, text_form
from ..sources.storage import move, path_exists

# Largest file, the size guess per value, and the codecs of snapshots and of changelogs.
MAX_FILE_BYTES = 10 << 30
BYTES_PER_VALUE = 1024
SNAPSHOT_CODEC = "snappy"
CHANGELOG_CODEC = "zstd"
# End of fixed values.

#: The writer's option that says whether a finished job leaves a ``_SUCCESS`` file.
MARKS_SUCCESS = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def rows_per_file(column_count: int, max_bytes: int = MAX_FILE_BYTES) -> int:
    """Rows a file may have so that its guessed size stays within ``max_bytes``."""
    return max(1, max_bytes // (max(1, column_count) * BYTES_PER_VALUE))


def write_parquet(
    df: DataFrame,
    path: str,
    codec: str = SNAPSHOT_CODEC,
    mode: str = "error",
    max_bytes: int = MAX_FILE_BYTES,
    partition_by: list[str] | None = None,
    marked: bool = True,
) -> None:
    """Parquet folder; each task starts a new file where one would grow past ``max_bytes``.

    Without ``marked`` the folder gets no ``_SUCCESS``; the caller creates it once all that belongs to it is done.
    """
    limit = rows_per_file(len(df.columns), max_bytes)
    writer = df.write.mode(mode).option("compression", codec).option("maxRecordsPerFile", limit)
    writer = writer.option(MARKS_SUCCESS, str(marked).lower())
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def _csv_value(field: T.StructField):
    value = col(field.name)
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return value.cast("string").alias(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return text_form(value, field.dataType).alias(field.name)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.to_json(value).alias(field.name)
    return value


def write_csv(
    df: DataFrame,
    folder: str,
    name_template: str | None = None,
    header: bool = True,
    delimiter: str = ",",
    if_exists: str = "error",
    now: Any = None,
    model_name: str = "export",
) -> str:
    """CSV under a name from a template; returns where it went.

    The name is a folder that all tasks write to. If it exists: ``error``, ``overwrite``, or ``archive`` (the old one
    moves to ``archive/`` first). Nested values are written as JSON, numbers as in the row fingerprint.
    """
    now = dt.datetime.fromisoformat(now) if isinstance(now, str) else now or dt.datetime.now(dt.timezone.utc)
    name = expand_file_name(name_template or "export_{timestamp}.csv", now, model_name)
    path = f"{folder.rstrip('/')}/{name}"
    if if_exists not in ("error", "overwrite", "archive"):
        raise ValueError(f"if_exists must be error, overwrite or archive, not {if_exists!r}")
    if if_exists == "archive" and path_exists(df.sparkSession, path):
        stamp = expand_file_name("{timestamp}", now)
        move(df.sparkSession, path, f"{folder.rstrip('/')}/archive/{name}.{stamp}.bak")
    rows = df.select(*[_csv_value(f) for f in df.schema.fields])
    rows.write.mode("overwrite" if if_exists == "overwrite" else "error").options(
        header=header, sep=delimiter, quote='"', escape='"'
    ).csv(path)
    return path
