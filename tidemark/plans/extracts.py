"""Writing the extract of one partition value."""

from __future__ import annotations

from collections.abc import Mapping
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import col
from ..operators.cdc import live_rows
from ..operators.partitions import extract_column, extract_name
from ..sinks.files import write_parquet


FOLDER = "extract_value"


def extract_path(base: str, slug: str, value: str | None, table: str) -> str:
    """Where the extract of one table for one value lies."""
    return f"{_table_path(base, slug, table)}/{FOLDER}={extract_name(value)}"


def _table_path(base: str, slug: str, table: str) -> str:
    return f"{base.rstrip('/')}/{slug}/{quote(table, safe='')}"


def write_partition(tables: Mapping[str, DataFrame], base: str, slug: str, value: str) -> dict[str, int]:
    """Write the tables :func:`~tidemark.operators.partitions.build_partition` made, one folder each.

    Returns the rows per table, counted while they are written, and ``total_rows``. An earlier extract is replaced.
    """
    counts = {}
    for name, df in tables.items():
        seen = Observation()
        write_parquet(df.observe(seen, F.count("*").alias("rows")), extract_path(base, slug, value, name), mode="overwrite")
        counts[name] = seen.get["rows"]
    return counts | {"total_rows": sum(counts.values())}


def build_all_partitions(
    models: Mapping[str, DataFrame | None],
    column: str,
    base: str,
    slug: str,
    aliases: Mapping[str, str] | None = None,
    codec: str = "snappy",
    live_only: bool = False,
) -> dict[str, int]:
    """The extracts of every model for all values of ``column`` at once, where :func:`write_partition` would put them.

    Folders are named after an encoded copy of the value, numbers by their amount: a folder holds the rows that a single extract for
    its value has (``'007'`` beside ``'7'``). The column itself stays in the files, with its type; the empty text and NULL stay apart. The rebalance gathers each value in few files and splits a value
    that is too large for one task. Models without data (None) are skipped. Returns the rows per table and ``total_rows``.
    """
    counts = {}
    for model, df in models.items():
        if df is None:
            continue
        name, seen = (aliases or {}).get(model) or model, Observation()
        rows = (live_rows(df) if live_only else df).observe(seen, F.count("*").alias("rows"))
        named = rows.withColumn(FOLDER, extract_column(col(column)))
        writer = named.hint("rebalance", col(FOLDER)).write.mode("overwrite").option("compression", codec)
        writer.partitionBy(FOLDER).parquet(_table_path(base, slug, name))
        counts[name] = seen.get["rows"]
    if not counts:
        raise ValueError("no model of this partition rule has data")
    return counts | {"total_rows": sum(counts.values())}


def read_extracts(spark: SparkSession, base: str, slug: str, table: str) -> DataFrame:
    """All extracts of a table."""
    return spark.read.parquet(_table_path(base, slug, table)).drop(FOLDER)
