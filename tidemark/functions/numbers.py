"""Numbers as text that compares like the numbers, exactly and at any length."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A sign, digits with a point somewhere, and an exponent of at most nine digits, among white space.
NUMERIC = r"^\s*([+-]?)([0-9]*)(?:\.([0-9]*))?(?:[eE]([+-]?[0-9]{1,9}))?\s*$"
_DIGITS, _REVERSED = "0123456789", "9876543210"
_MIDDLE = 5_000_000_000  # of the exponents, which are written with ten digits


def number_key(text: str) -> str | None:
    """The key of a number's text, or None if the text is no number.

    Equal numbers have equal keys (``7``, ``007``, ``7.0``, ``70e-1``), and keys sort like the numbers: a letter for the sign, the
    exponent of ``0.d1d2... * 10^exponent``, and the digits without zeros at either end. Below zero exponent and digits are turned
    round and end in a character above the digits.
    """
    match = re.fullmatch(NUMERIC, text, re.ASCII)
    if not match or not (match[2] or match[3]):
        return None
    sign, whole, part, power = match[1], match[2], match[3] or "", int(match[4] or 0)
    digits = (whole + part).lstrip("0")
    if not digits:
        return "1"
    exponent = f"{power + len(digits) - len(part) + _MIDDLE:010d}"
    kept = digits.rstrip("0")
    if sign != "-":
        return f"2{exponent}{kept}"
    turned = str.maketrans(_DIGITS, _REVERSED)
    return f"0{exponent.translate(turned)}{kept.translate(turned)}~"


def number_key_column(text: Column) -> Column:
    """:func:`number_key` of a text column, NULL for what is no number."""
    sign, whole = F.regexp_extract(text, NUMERIC, 1), F.regexp_extract(text, NUMERIC, 2)
    part, power = F.regexp_extract(text, NUMERIC, 3), F.regexp_extract(text, NUMERIC, 4)
    every = F.concat(whole, part)
    digits = F.ltrim(every, F.lit("0"))
    shift = F.when(power != "", power).otherwise("0").cast("bigint")
    exponent = F.lpad((shift + F.length(digits) - F.length(part) + F.lit(_MIDDLE)).cast("string"), 10, "0")
    kept = F.rtrim(digits, F.lit("0"))
    below = F.concat(F.lit("0"), F.translate(exponent, _DIGITS, _REVERSED), F.translate(kept, _DIGITS, _REVERSED), F.lit("~"))
    above = F.concat(F.lit("2"), exponent, kept)
    key = F.when(digits == "", F.lit("1")).when(sign == "-", below).otherwise(above)
    return F.when(text.rlike(NUMERIC) & (every != ""), key)


def value_key(text: str) -> str:
    """One text per value of a partition column: ``n`` and the key of a number, or ``t`` and the text."""
    key = number_key(text)
    return f"t{text}" if key is None else f"n{key}"


def value_key_column(value: Column) -> Column:
    """:func:`value_key` of a column, NULL for NULL."""
    text = value.cast("string")
    key = number_key_column(text)
    return F.when(key.isNotNull(), F.concat(F.lit("n"), key)).otherwise(F.concat(F.lit("t"), text))
