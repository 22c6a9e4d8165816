"""Extracts of the tables for one value of a partition column."""

from __future__ import annotations

import re
from collections.abc import Mapping
from decimal import Decimal, localcontext
from functools import reduce
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import col, number_key, number_key_column, value_key, value_key_column
from .cdc import live_rows

_LONGEST_NAME = 100
_PLAIN_NAME = re.compile(r"[A-Za-z0-9_.-]{1,100}")


#: Name of the stored column that makes a partition filter reach the scan, see :func:`with_value_key`.
KEY_PREFIX = "$_value_key "


def _equals(value: Column, data_type: T.DataType, text: str) -> Column:
    """``value`` = ``text``, with the literal in the type of the column so that the filter reaches the scan."""
    key = number_key(text)
    if key is None:
        return value == F.lit(text).try_cast(data_type)
    if isinstance(data_type, T.StringType):
        # A numeric value compares as a number, exactly: 7 finds '7', '007' and '7e0'.
        return number_key_column(value) == key
    if isinstance(data_type, T.BooleanType):
        return value == F.lit(key != number_key("0"))
    if isinstance(data_type, (T.IntegralType, T.DecimalType)):
        number = Decimal(text.strip())
        if not -40 <= number.adjusted() <= 40 and number:
            return F.lit(False) & value.isNotNull()  # beyond every such type
        with localcontext() as exact:
            exact.prec = 200
            places = data_type.scale if isinstance(data_type, T.DecimalType) else 0
            fits = len(key) < 200 and number == round(number, places)
            near = F.lit(format(round(number, places), "f")).try_cast(data_type)
        return value == near if fits else F.lit(False) & value.isNotNull()
    return value == F.lit(text.strip()).try_cast(data_type)


def with_value_key(df: DataFrame, column: str) -> DataFrame:
    """The rows with a column that tells the value of ``column`` in one form, numbers by their amount.

    Stored with the rows it lets :func:`partition_filter` compare one text with one text, which is pushed to the scan, also where
    ``column`` is text that spells numbers in several ways. It is a system column: it is not part of fingerprints.
    """
    return df.withColumn(KEY_PREFIX + column, value_key_column(col(column)))


def partition_filter(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows whose ``column`` equals ``value``; text that looks like a number compares as one, exactly."""
    stored = KEY_PREFIX + column
    if stored in df.columns and isinstance(df.schema[column].dataType, T.StringType):
        return df.where(col(stored) == value_key(value))
    return df.where(_equals(col(column), df.schema[column].dataType, value))


def build_partition(
    models: Mapping[str, DataFrame | None],
    column: str,
    value: str,
    aliases: Mapping[str, str] | None = None,
    live_only: bool = False,
) -> dict[str, DataFrame]:
    """The extract of every model, under its alias or name. Models without data (None) are skipped."""
    built = {
        (aliases or {}).get(name) or name: partition_filter(live_rows(df) if live_only else df, column, value)
        for name, df in models.items()
        if df is not None
    }
    if not built:
        raise ValueError("no model of this partition rule has data")
    return built


def extract_name(value: str | None) -> str:
    """A value as a folder name: a number's key, else the text if it is plain, else its bytes in hexadecimal digits, or their digest
    if too long. So a folder holds what :func:`partition_filter` finds: ``7``, ``007`` and ``7e0`` share one."""
    if value is None:
        return "null"
    key = number_key(value)
    if key is not None:
        return f"n-{key}" if len(key) <= _LONGEST_NAME else f"m-{sha256(key.encode()).hexdigest()}"
    if _PLAIN_NAME.fullmatch(value):
        return f"s-{value}"
    raw = value.encode()
    return f"x-{raw.hex().upper()}" if len(raw) <= _LONGEST_NAME else f"h-{sha256(raw).hexdigest()}"


def extract_column(value: Column) -> Column:
    """:func:`extract_name` of a column."""
    text = value.cast("string")
    key = number_key_column(text)
    number = F.when(F.length(key) <= _LONGEST_NAME, F.concat(F.lit("n-"), key)).otherwise(F.concat(F.lit("m-"), F.sha2(key, 256)))
    plain = text.rlike(f"^(?:{_PLAIN_NAME.pattern})$")
    short = F.concat(F.lit("x-"), F.hex(F.encode(text, "UTF-8")))
    named = F.when(key.isNotNull(), number).when(plain, F.concat(F.lit("s-"), text)).when(F.octet_length(text) <= _LONGEST_NAME, short)
    named = F.when(text.isNotNull(), named.otherwise(F.concat(F.lit("h-"), F.sha2(text, 256))))
    return F.coalesce(named, F.lit("null"))


def partition_stats(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, and ``total_rows`` over all of them."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    per_table = reduce(DataFrame.unionAll, counts)
    total = per_table.agg(F.sum("row_count").alias("row_count"))
    return per_table.unionAll(total.select(F.lit("total_rows").alias("table_name"), "row_count"))
