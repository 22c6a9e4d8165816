"""Casts that turn bad values into NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared type names (any letter case) and the Spark type each stands for.
DECLARED_TYPES = {
    "number": "double",
    "double": "double",
    "float": "double",
    "integer": "bigint",
    "int": "bigint",
    "bigint": "bigint",
    "boolean": "boolean",
    "bool": "boolean",
    "date": "date",
    "timestamp": "timestamp_ntz",
    "datetime": "timestamp_ntz",
}
# End of fixed values.

_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_NOT_FINITE = r"(?i)^\s*[+-]?(inf|infinity|nan)\s*$"
_DATE = r"^\s*[+-]?[0-9]{1,6}[-/][0-9]{1,2}[-/][0-9]{1,2}"


def spark_type(type_name: str | None) -> str | None:
    """The Spark type of a declared type name; None when values are to be left as they are."""
    return DECLARED_TYPES.get(type_name.lower()) if type_name else None


def is_date_type(type_name: str | None) -> bool:
    return spark_type(type_name) in ("date", "timestamp_ntz")


def safe_cast(value: Column, type_name: str | None, source: T.DataType | None = None) -> Column:
    """``value`` as the declared type, NULL where it cannot be.

    ``source`` is the type of ``value``; text is assumed when it is not given. Whole numbers are rounded, not cut:
    halves go to even from floating point, away from zero from text and decimals.
    """
    target = spark_type(type_name)
    if target is None:
        return value
    if source is None or isinstance(source, (T.StringType, T.CharType, T.VarcharType)):
        return _from_text(value, target)
    if target == "bigint" and isinstance(source, (T.DoubleType, T.FloatType)):
        return F.bround(value).try_cast("bigint")
    if target == "bigint" and isinstance(source, T.DecimalType):
        return F.round(value).try_cast("bigint")
    return value.try_cast(target)


def _from_text(text: Column, target: str) -> Column:
    if target == "bigint":
        rounded = F.round(text.try_cast("decimal(38,18)")).try_cast("bigint")
        return F.coalesce(text.try_cast("bigint"), rounded)
    if target == "double":
        return F.when(text.rlike(_NUMBER) | text.rlike(_NOT_FINITE), text.try_cast("double"))
    if target in ("date", "timestamp_ntz"):
        dashed = F.translate(text, "/", "-")
        moment = F.when(text.rlike(_DATE), dashed.try_cast("timestamp_ntz"))
        if target == "timestamp_ntz":
            return moment
        # What follows a date must be a valid time of day, though it is not used.
        return F.when(text.rlike(_DATE + r"\s*$"), dashed.try_cast("date")).otherwise(moment.cast("date"))
    return F.when(text.rlike(r"^\S+$"), text.try_cast(target))  # boolean words stand without space around them


def zero_date_to_null(value: Column, type_name: str | None) -> Column:
    """NULL for the empty dates some databases hand out; only for date and timestamp types.

    Works on raw text and on a value already cast. A plain date of year 1 prints no time and is kept.
    """
    if not is_date_type(type_name):
        return value
    text = value.cast("string")
    # The values below are fixed: the spellings of an empty date.
    empty = text.isin("", "NULL") | text.startswith("0000-00-00")
    first_instant = text.endswith("-01-01 00:00:00") & (F.year(text.try_cast("date")) <= 1)
    return F.when(~(empty | F.coalesce(first_instant, F.lit(False))), value)
