"""Scans of files, and the choice of the file to scan."""

from __future__ import annotations

import re
from collections.abc import Sequence
from operator import attrgetter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import col, wildcard_to_regex
from .storage import entries, finished

# File selection strategies, with and without their long names.
BY_DATE = ("date", "most_recent_by_date")
BY_NAME = ("name", "most_recent_by_name")
# End of fixed values.

BAD_LINE = "__bad line"


def _plain_types(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint and zoned timestamps as wall-clock time, as the sync engine stores inferred types."""

    def plain(field: T.StructField):
        value = col(field.name)
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return value.cast("bigint").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return value.cast("timestamp_ntz").alias(field.name)
        return value

    return df.select(*[plain(f) for f in df.schema.fields])


def _set_aside(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the lines that did not fit with the file they come from."""
    # Spark refuses to read the line alone; a test that always holds asks for a data column too.
    data = next((c for c in rows.columns if c != BAD_LINE), None)
    if data is None:
        raise ValueError("no column could be read")
    read = F.length(F.coalesce(F.to_json(F.struct(col(data))), F.lit(""))) >= 0
    good = rows.where(col(BAD_LINE).isNull() & read).drop(BAD_LINE)
    bad = rows.select("*", F.col("_metadata.file_path").alias("file")).where(col(BAD_LINE).isNotNull() & read)
    return good, bad.select("file", col(BAD_LINE).alias("line"))


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    infer: bool = True,
    delimiter: str = ",",
    multiline: bool = False,
    bad_rows: str = "fail",
):
    """CSV with a header. Inferring types reads the data once more: with a declared stream schema pass
    ``infer=False`` and let the casts do it. ``multiline`` allows line breaks in quotes but makes each file one task.

    A row with more or fewer values than the header, or a file whose header differs from the first one's, is an error.
    ``bad_rows="aside"`` gives two frames, the good rows and the bad ``line`` s with their ``file``; headers stay strict.
    """
    if bad_rows not in ("fail", "aside"):
        raise ValueError(f"bad_rows is 'fail' or 'aside': {bad_rows!r}")

    def reader(mode: str):
        made = spark.read.options(header=True, sep=delimiter, quote='"', escape='"', multiLine=multiline, mode=mode)
        made = made.options(nanValue="nan", positiveInf="inf", negativeInf="-inf", columnNameOfCorruptRecord=BAD_LINE)
        # Headers are checked against the schema, and every row is parsed in full, also where few columns are asked for.
        return made.options(enforceSchema=False, columnPruning=False)

    declared = schema is not None
    if bad_rows == "fail" and not declared and not infer:
        return reader("FAILFAST").csv(path)
    if not declared:  # types are inferred leniently; the scan itself is strict
        schema = reader("PERMISSIVE").option("inferSchema", infer).csv(path).schema
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if bad_rows == "fail":
        rows = reader("FAILFAST").schema(schema).csv(path)
        return rows if declared else _plain_types(rows)
    marked = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    good, bad = _set_aside(reader("PERMISSIVE").schema(marked).csv(path))
    return good if declared else _plain_types(good), bad


def read_json(
    spark: SparkSession,
    path: str,
    multiline: bool | None = None,
    schema: T.StructType | str | None = None,
    columns: Sequence[str] | None = None,
    bad_rows: str = "fail",
):
    """JSON, one object per line or (``multiline``) an array per file; told apart by the first character if not said.

    Columns come in the order of ``columns`` (the previous snapshot's, say), others by name after them: the row fingerprint
    depends on the order, so it does not depend on which file is larger. A line that is no object is an error;
    ``bad_rows="aside"`` gives two frames, the good rows and the bad ``line`` s with their ``file``.
    """
    if bad_rows not in ("fail", "aside"):
        raise ValueError(f"bad_rows is 'fail' or 'aside': {bad_rows!r}")
    if multiline is None:
        start = spark.read.text(path).where("trim(value) <> ''").select(F.substring(F.ltrim("value"), 1, 1)).first()
        multiline = start is not None and start[0] == "["
    reader = spark.read.options(multiLine=multiline, inferTimestamp=True)
    mode = "FAILFAST" if bad_rows == "fail" else "PERMISSIVE"
    reader = reader.options(mode=mode, columnNameOfCorruptRecord=BAD_LINE)
    declared = schema is not None
    if not declared:
        schema = reader.json(path).schema
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = [f.name for f in schema.fields if f.name != BAD_LINE]
    if not declared:
        first = [c for c in columns or () if c in names]
        names = first + sorted(set(names) - set(first))
    if bad_rows == "fail":
        rows = reader.schema(schema).json(path).select(*[col(c) for c in names])
        return rows if declared else _plain_types(rows)
    marked = T.StructType([f for f in schema.fields if f.name != BAD_LINE] + [T.StructField(BAD_LINE, T.StringType())])
    good, bad = _set_aside(reader.schema(marked).json(path))
    good = good.select(*[col(c) for c in names])
    return (good if declared else _plain_types(good)), bad


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


_READERS = {"csv": read_csv, "json": read_json, "parquet": read_parquet}


def file_format(path: str) -> str:
    """The format a path's extension names; anything unknown is CSV."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    extension = name.rsplit(".", 1)[-1].lower()
    return extension if extension in _READERS else "csv"


def read_source(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    """A file or folder by format, or by extension when no format is given."""
    return _READERS[fmt or file_format(path)](spark, path, **options)


def resolve_path(base: str, name: str) -> str:
    """An absolute ``name`` as it is, else ``name`` inside ``base`` without doubled slashes."""
    if not name:
        raise ValueError("no file named for this source")
    if name.startswith("/"):
        return name
    scheme, mark, rest = f"{base}/{name}".rpartition("://")
    return scheme + mark + rest.replace("//", "/")


def latest_file(
    spark: SparkSession, folder: str, pattern: str | None = None, strategy: str = "date"
) -> DataFrame:
    """The newest file of ``folder`` by modification time or by name: one row (path, name, modified_at, size), or none.

    Only entries directly in the folder count: plain files, and folders that a finished job wrote (with its ``_SUCCESS``), as
    the exports of this library are. ``pattern`` is a wildcard that may match anywhere in the name. Names that start with
    ``_`` or ``.`` are hidden. The folder is listed by the driver; the content is not read.
    """
    wanted = re.compile(wildcard_to_regex(pattern)) if pattern else None
    if strategy in BY_NAME:
        order = attrgetter("name")
    elif strategy in BY_DATE:
        order = attrgetter("modified_ms", "name")
    else:
        raise ValueError(f"unknown file selection strategy: {strategy!r}")
    found = [
        e
        for e in entries(spark, folder)
        if e.name[0] not in "_." and (wanted is None or wanted.search(e.name)) and (not e.is_folder or finished(spark, e.path))
    ]
    newest = max(found, key=order, default=None)
    rows = [(newest.path, newest.name, newest.modified_ms, newest.size)] if newest else []
    frame = spark.createDataFrame(rows, "path string, name string, ms long, size long")
    return frame.select("path", "name", F.timestamp_millis("ms").alias("modified_at"), "size")


def read_latest(
    spark: SparkSession,
    folder: str,
    pattern: str | None = None,
    strategy: str = "date",
    fmt: str | None = None,
    **options,
) -> DataFrame:
    """Scan the file :func:`latest_file` picks, with the options of its format's reader."""
    found = latest_file(spark, folder, pattern, strategy).select("path").first()
    if found is None:
        raise FileNotFoundError(f"no file in {folder} matches {pattern or '*'}")
    return read_source(spark, found["path"], fmt, **options)
