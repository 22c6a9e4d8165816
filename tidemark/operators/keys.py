"""Rows by key: non-NULL keys, one row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import HASH_COLUMN, col, data_columns, row_hash


def keys_not_null(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in which every key column has a value (NaN is a value)."""
    return df.where(reduce(and_, [col(k).isNotNull() for k in keys]))


def dedup_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str | Column | Sequence[str | Column] | None = None,
    apart: bool = False,
) -> DataFrame:
    """One row per key: the first by ``order_by``, ties by row fingerprint, so a rerun keeps the same row.

    The rank filter becomes a group limit in front of the shuffle: each task sends at most one row per key, so a
    key with a third of all rows stays cheap. A join on the same keys reuses the shuffle, unless ``apart`` asks for
    one of its own (see :func:`apart_by`).
    """
    if order_by is None:
        order_by = []
    elif isinstance(order_by, (str, Column)):
        order_by = [order_by]
    order = [col(o) if isinstance(o, str) else o for o in order_by]
    fingerprint = col(HASH_COLUMN) if HASH_COLUMN in df.columns else row_hash(df, data_columns(df.columns))
    # Different rows may share a fingerprint (NULL and empty text, a bar inside a value); this tells them apart.
    hashable = [f.name for f in df.schema.fields if _hashable(f.dataType)]
    order += [fingerprint, F.xxhash64(*[col(c) for c in hashable])]
    groups = apart_by(keys) if apart else [col(k) for k in keys]
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys alone, once each. Merged before the shuffle, and shuffled as a join on them needs it."""
    return df.select(*[col(k) for k in keys]).dropDuplicates()


def apart_by(keys: Sequence[str]) -> list[Column]:
    """Grouping columns for the unique side of a join whose other side may repeat a key without limit.

    Groups are those of ``keys``. The extra column makes the join shuffle the groups once more, which is what lets AQE
    split a skewed partition of the other side: it does so only where both inputs of the join are plain shuffles.
    """
    return [*[col(k) for k in keys], F.xxhash64(*[col(k) for k in keys]).alias("__apart")]


def likely_among(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose ``key`` is in ``wanted`` (its only column), and a few others.

    To be put before a join on the key, so that its shuffle moves little. The hashes of the wanted keys mark bits in 256 bitmaps of
    4 KB; that is what is broadcast, however many keys there are. The more keys, the more other rows stay.
    """
    spread = F.pmod(F.xxhash64(col(key)), F.lit(1 << 23))
    marked = wanted.select(F.pmod(F.xxhash64(col(wanted.columns[0])), F.lit(1 << 23)).alias("__place"))
    marked = marked.groupBy(F.shiftright("__place", 15).alias("__group"))
    marks = marked.agg(F.bitmap_construct_agg(F.col("__place").bitwiseAND(F.lit(32767))).alias("__bits"))
    place = spread.bitwiseAND(F.lit(32767))
    byte = F.conv(F.hex(F.substring("__bits", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked_here = byte.bitwiseAND(F.pow(F.lit(2), place.bitwiseAND(F.lit(7))).cast("int")) != 0
    same = F.shiftright(spread, 15) == F.col("__group")
    return rows.join(F.broadcast(marks), same & marked_here).drop("__group", "__bits")


def _hashable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _hashable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_hashable(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType))
