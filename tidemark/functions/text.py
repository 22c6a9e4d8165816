"""Text form of values and the row fingerprint."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .names import col


def text_form(value: Column, data_type: T.DataType) -> Column:
    """The text that goes into the row fingerprint.

    Spark's own cast, but for floating point: there the fingerprint uses plain notation from 1e-4 up to 1e16 and
    a signed two-digit exponent outside (``12345678.9``, ``1e+16``, ``1.5e-05``), and ``inf``/``nan``. Nested values have a form
    of their own, see :func:`nested_form`.
    """
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.when(value.isNotNull(), nested_form(value, data_type))
    text = value.cast("string")
    if not isinstance(data_type, (T.DoubleType, T.FloatType)):
        return text
    size = F.abs(value)
    # Spark switches to E notation at 1e7 and below 1e-3; the decimal holds every digit of that text.
    plain = F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), r"(\.\d+?)0*$", "$1")
    digits, power = F.substring_index(text, "E", 1), F.substring_index(text, "E", -1)
    # Java 17 may print a digit more than it takes to tell this number from its neighbors.
    shorter = digits.try_cast("decimal(17,15)").cast("string")
    enough = F.concat(shorter, F.lit("E"), power).try_cast(data_type) == value
    mantissa = F.when(enough, shorter).otherwise(digits.try_cast("decimal(18,16)").cast("string"))
    mantissa = F.regexp_replace(mantissa, r"\.?0+$", "")
    exponent = F.format_string("e%+03d", power.try_cast("int"))

    def limit(number: float) -> Column:
        return F.lit(number).cast(data_type)

    # NaN orders above every number, so it is tested first.
    return (
        F.when(F.isnan(value), "nan")
        .when(size == float("inf"), F.when(value > 0, "inf").otherwise("-inf"))
        .when((size >= limit(1e16)) | ((size < limit(1e-4)) & (size > 0)), F.concat(mantissa, exponent))
        .when((size >= limit(1e7)) | ((size < limit(1e-3)) & (size > 0)), plain)
        .otherwise(text)
    )


def nested_form(value: Column, data_type: T.DataType) -> Column:
    """A text that is the same for equal nested values and different for others.

    Texts and numbers carry their length (``1:7``), NULL is a tilde, and the parts of a value are joined in brackets: arrays in
    their order, structs field by field, maps with their entries sorted, as a reader may give them in any order.
    """
    if isinstance(data_type, T.ArrayType):
        parts = F.transform(value, lambda x: nested_form(x, data_type.elementType))
        form = F.concat(F.lit("["), F.array_join(parts, ","), F.lit("]"))
    elif isinstance(data_type, T.MapType):

        def entry(e: Column) -> Column:
            pair = nested_form(e["key"], data_type.keyType), nested_form(e["value"], data_type.valueType)
            return F.concat(pair[0], F.lit("="), pair[1])

        parts = F.array_sort(F.transform(F.map_entries(value), entry))
        form = F.concat(F.lit("<"), F.array_join(parts, ","), F.lit(">"))
    elif isinstance(data_type, T.StructType):
        parts = [nested_form(value.getField(f.name), f.dataType) for f in data_type.fields]
        form = F.concat(F.lit("("), F.concat_ws(",", *parts), F.lit(")"))
    else:
        text = F.hex(value) if isinstance(data_type, T.BinaryType) else text_form(value, data_type)
        form = F.concat(F.length(text).cast("string"), F.lit(":"), text)
    return F.when(value.isNotNull(), form).otherwise(F.lit("~"))


def row_hash(df: DataFrame, columns: Iterable[str]) -> Column:
    """md5 over the text of ``columns`` in order, joined by a bar, NULL as empty text."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = [F.coalesce(text_form(col(c), types[c]), F.lit("")) for c in columns]
    return F.md5(F.concat_ws("|", *parts))
