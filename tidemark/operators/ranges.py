"""Joins of a value with the intervals it lies in, without comparing every pair.

An interval belongs to the level whose bins, a power of two wide, are at least as long as it is; so it touches two bins at most, or
three by rounding, however long it is. A value is looked up in its one bin of each level that occurs. That makes an equality join, of
which every pair is checked again exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import col
from ..session import cut_lineage

AT, LEVEL, BIN = "$_range_at", "$_range_level", "$_range_bin"
EVERYTHING = 1024  # level of intervals without an end, which have one bin
SMALLEST = -900  # level of intervals of no length around 0
DIGITS = 50  # bits of a double that tell bins apart


def has_order(data_type: T.DataType) -> bool:
    """Whether values of a type can be binned."""
    return isinstance(data_type, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _number(df: DataFrame, name: str) -> Column:
    """A column as doubles that keep its order (different values may become one)."""
    data_type, value = df.schema[name].dataType, col(name)
    if not has_order(data_type):
        raise ValueError(f"no range join over {data_type.simpleString()}")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        value = F.unix_micros(value.cast("timestamp"))
    elif isinstance(data_type, T.DateType):
        value = F.unix_date(value)
    return value.cast("double")


def _log2_up(value: Column) -> Column:
    """A whole number whose power of two is not below the value."""
    least = F.when(value > 0, F.ceil(F.log2(value)) + 1).otherwise(F.lit(SMALLEST))
    return F.when(value >= 2.0**1000, F.lit(EVERYTHING)).otherwise(least)


def binned_intervals(df: DataFrame, low: str, high: str) -> tuple[DataFrame, list[int]]:
    """The rows with an interval, one for each bin it touches, and the levels that occur (1,100 at most)."""
    a, b = _number(df, low), _number(df, high)
    reach = F.greatest(F.abs(a), F.abs(b))
    level = F.greatest(_log2_up(b - a), _log2_up(reach) - DIGITS)
    endless = (reach == float("inf")) | (level >= EVERYTHING - 4)
    usable = df.where((a <= b) & ~F.isnan(a) & ~F.isnan(b))
    leveled = usable.withColumn(LEVEL, F.when(endless, F.lit(EVERYTHING)).otherwise(level).cast("int"))
    width = F.pow(F.lit(2.0), col(LEVEL).cast("double"))
    first, last = F.floor(a / width), F.floor(b / width)
    touched = F.array_distinct(F.array(first, F.least(first + 1, last), last))  # three at most, as a bin is at least as long
    bins = F.when(col(LEVEL) == EVERYTHING, F.array(F.lit(0).cast("bigint"))).otherwise(touched)
    return leveled.withColumn(BIN, F.explode(bins)), sorted(r[0] for r in leveled.select(col(LEVEL)).distinct().collect())


def binned_points(df: DataFrame, point: str, levels: Sequence[int]) -> DataFrame:
    """The rows with a value, one for each level, with their bin there."""
    value = _number(df, point)
    at = [
        F.struct(F.lit(k).alias("level"), (F.lit(0) if k == EVERYTHING else F.floor(value / 2.0**k)).cast("bigint").alias("bin"))
        for k in levels
    ]
    if not at:
        return df.limit(0).withColumn(AT, F.lit(None).cast("struct<level:int,bin:bigint>"))
    return df.where(col(point).isNotNull() & ~F.isnan(value)).withColumn(AT, F.explode(F.array(*at)))


def range_join(
    left: DataFrame, right: DataFrame, point: str, low: str, high: str, how: str = "inner", closed: str = "both"
) -> DataFrame:
    """Rows of ``left`` with the rows of ``right`` whose interval ``[low, high]`` holds their ``point``.

    ``closed`` says which ends belong to the interval: both, left, right or neither. ``how`` is inner, left, right or full. A NULL
    or NaN in point or end meets nothing, nor does an interval whose ends are the wrong way round. Repeated rows all meet. The
    columns of both sides come as they are, so a name may repeat, as in any join.

    An outer join checkpoints the sides it keeps, so that their rows can be numbered.
    """
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"how is inner, left, right or full: {how!r}")
    if closed not in ("both", "left", "right", "neither"):
        raise ValueError(f"closed is both, left, right or neither: {closed!r}")
    names = {"l": left.columns, "r": right.columns}
    kept = {"l": how in ("left", "full"), "r": how in ("right", "full")}
    sides = {"l": left, "r": right}
    for side, number in (("l", "$_left_row"), ("r", "$_right_row")):
        if kept[side]:
            sides[side] = cut_lineage(sides[side].withColumn(number, F.monotonically_increasing_id()))
    pieces, levels = binned_intervals(sides["r"], low, high)
    x, y = binned_points(sides["l"], point, levels).alias("l"), pieces.alias("r")
    value, begin, end = F.col(f"l.`{point}`"), F.col(f"r.`{low}`"), F.col(f"r.`{high}`")
    inside = (value >= begin if closed in ("both", "left") else value > begin) & (
        value <= end if closed in ("both", "right") else value < end
    )
    met = x.join(y, (F.col(f"l.`{AT}`.level") == F.col(f"r.`{LEVEL}`")) & (F.col(f"l.`{AT}`.bin") == F.col(f"r.`{BIN}`")) & inside)
    columns = [F.col(f"{side}.`{c}`") for side in names for c in names[side]]
    if how == "inner":
        return met.select(*columns)
    met = cut_lineage(met.select(*columns, *[col(n) for s, n in (("l", "$_left_row"), ("r", "$_right_row")) if kept[s]]))
    width = len(names["l"]) + len(names["r"])
    pairs = met.toDF(*[f"c{i}" for i in range(len(met.columns))])
    out = pairs.select(*[f"c{i}" for i in range(width)])
    for side, number in (("l", "$_left_row"), ("r", "$_right_row")):
        if not kept[side]:
            continue
        at = f"c{width + (1 if side == 'r' and kept['l'] else 0)}"
        alone = sides[side].join(pairs.select(F.col(at).alias(number)).distinct(), number, "left_anti")
        own = {"l": [col(c) for c in names["l"]], "r": [F.lit(None).cast(f.dataType) for f in right.schema]}
        if side == "r":
            own = {"l": [F.lit(None).cast(f.dataType) for f in left.schema], "r": [col(c) for c in names["r"]]}
        out = out.unionAll(alone.select(*own["l"], *own["r"]))
    return out.toDF(*names["l"], *names["r"])
