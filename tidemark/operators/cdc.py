"""Change detection between two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (
    HASH_COLUMN,
    LAST_UPDATED,
    OPERATION,
    TIMESTAMP,
    as_timestamp,
    col,
    data_columns,
)
from ..session import cut_lineage
from .keys import apart_by, dedup_by_key, keys_not_null
from .projection import ensure_row_hash, tag

# The operations that count as a change.
CHANGE_OPERATIONS = ("INSERT", "UPDATE", "DELETE", "SNAPSHOT")
# End of fixed values.


def changes_only(cdc: DataFrame) -> DataFrame:
    """All rows but the unchanged ones."""
    return cdc.where(col(OPERATION).isin(*CHANGE_OPERATIONS))


def live_rows(df: DataFrame) -> DataFrame:
    """Rows that still exist: without the DELETE rows a compared snapshot carries."""
    if OPERATION not in df.columns:
        return df
    return df.where(~col(OPERATION).eqNullSafe("DELETE"))


def cdc_compare(
    current: DataFrame,
    previous: DataFrame,
    keys: Sequence[str],
    now: Any,
    order_by: str | Column | Sequence[str | Column] | None = None,
) -> DataFrame:
    """Tag each key of either version as INSERT, UPDATE, DELETE or NO_CHANGE.

    Rows with a NULL in the key are left out and repeated keys keep one row. Values come from ``current``, for
    DELETE from ``previous``. Columns that only ``previous`` has are dropped; columns that only ``current`` has
    are NULL on DELETE. ``order_by`` chooses the row a repeated key keeps.

    One full outer join of two sides that are unique by key, hence free of skew. The rank per key and the join share
    one shuffle per side; a bucketed ``previous`` (see ``plans.store``) needs none.
    """
    current = ensure_row_hash(current)
    previous = ensure_row_hash(previous)
    data = data_columns(current.columns)
    types = {f.name: f.dataType for f in current.schema.fields}
    old_types = {f.name: f.dataType for f in previous.schema.fields}

    cur = dedup_by_key(keys_not_null(current.select(*[col(c) for c in data], col(HASH_COLUMN)), keys), keys, order_by)
    kept = [c for c in data if c in old_types] + [HASH_COLUMN]
    has_time = LAST_UPDATED in old_types
    if has_time:
        kept.append(LAST_UPDATED)
    old = keys_not_null(previous.select(*[col(c) for c in kept]), keys)
    named = [order_by] if isinstance(order_by, (str, Column)) else list(order_by or [])
    # The previous version may lack a column that orders the current rows.
    old = dedup_by_key(old, keys, named if all(_resolves(old, o) for o in named) else None)

    def aligned(name: str) -> Column:
        value = col(name)
        if name not in types or old_types[name] == types[name]:
            return value
        new = value.try_cast(types[name])
        if name not in keys:
            return new
        # A key must not turn into NULL, or nobody could say what was deleted.
        told = f"key {name}: previous value is {old_types[name].simpleString()} and does not fit {types[name].simpleString()}: "
        return F.when(value.isNotNull() & new.isNull(), F.raise_error(F.concat(F.lit(told), value.cast("string")))).otherwise(new)

    old = old.select(*[aligned(c).alias(_old(c)) for c in kept])
    joined = cur.join(old, reduce(and_, [col(k) == col(_old(k)) for k in keys]), "full_outer")

    inserted = col(_old(HASH_COLUMN)).isNull()
    deleted = col(HASH_COLUMN).isNull()
    updated = col(HASH_COLUMN) != col(_old(HASH_COLUMN))
    moment = as_timestamp(now)
    if has_time:
        changed_at = F.when(inserted, moment).when(deleted, col(_old(LAST_UPDATED))).when(updated, moment)
        changed_at = changed_at.otherwise(col(_old(LAST_UPDATED)))
    else:
        changed_at = moment
    values = [
        (F.when(deleted, col(_old(c))).otherwise(col(c)) if c in kept else col(c)).alias(c) for c in [*data, HASH_COLUMN]
    ]
    operation = F.when(inserted, "INSERT").when(deleted, "DELETE").when(updated, "UPDATE").otherwise("NO_CHANGE")
    return joined.select(
        *values, operation.alias(OPERATION), moment.alias(TIMESTAMP), changed_at.alias(LAST_UPDATED)
    )


SALTS = 256  # parts that the rows of one fingerprint are numbered in


def _numbered(df: DataFrame) -> DataFrame:
    """The rows of each fingerprint numbered from 1 in ``__number``.

    Rows are dealt out by a salt, numbered within it, and moved up by the counts of the smaller salts; so no task holds all rows of a
    fingerprint. The checkpoint keeps the salts, and with them the numbers, should a task be lost.
    """
    salted = cut_lineage(df.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")))
    counts = salted.groupBy(col(HASH_COLUMN).alias("__ref"), F.col("__salt").alias("__part")).agg(F.count("*").alias("__n"))
    smaller = Window.partitionBy("__ref").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__ref", "__part", F.coalesce(F.sum("__n").over(smaller), F.lit(0)).alias("__start"))
    local = Window.partitionBy(col(HASH_COLUMN), F.col("__salt")).orderBy(F.lit(1))
    rows = salted.withColumn("__local", F.row_number().over(local))
    placed = rows.join(starts, (col(HASH_COLUMN) == F.col("__ref")) & (F.col("__salt") == F.col("__part")))
    return placed.withColumn("__number", F.col("__start") + F.col("__local")).drop("__ref", "__part", "__salt", "__start", "__local")


def _counted_cdc(current: DataFrame, previous: DataFrame, moment: Column) -> DataFrame:
    """:func:`hash_cdc` with copies counted."""
    data = data_columns(current.columns)
    times = previous.groupBy(*apart_by([HASH_COLUMN])).agg(
        F.count("*").alias("__copies"), F.min(col(TIMESTAMP)).alias("__ts"), F.min(col(LAST_UPDATED)).alias("__lu")
    )
    times = times.select(col(HASH_COLUMN).alias("__ref"), "__copies", "__ts", "__lu")
    found = _numbered(current).join(times, col(HASH_COLUMN) == F.col("__ref"), "left")
    known = F.coalesce(F.col("__number") <= F.col("__copies"), F.lit(False))
    present = found.select(
        *[col(c) for c in data],
        col(HASH_COLUMN),
        F.lit("INSERT").alias(OPERATION),
        F.when(known, F.col("__ts")).otherwise(moment).alias(TIMESTAMP),
        F.when(known, F.col("__lu")).otherwise(moment).alias(LAST_UPDATED),
    )
    now_there = current.groupBy(*apart_by([HASH_COLUMN])).agg(F.count("*").alias("__copies"))
    now_there = now_there.select(col(HASH_COLUMN).alias("__ref"), "__copies")
    left = _numbered(previous).join(now_there, col(HASH_COLUMN) == F.col("__ref"), "left")
    gone = left.where(F.col("__number") > F.coalesce(F.col("__copies"), F.lit(0))).select(
        *[col(c) for c in data if c in previous.columns],
        col(HASH_COLUMN),
        F.lit("DELETE").alias(OPERATION),
        col(TIMESTAMP),
        moment.alias(LAST_UPDATED),
    )
    return present.unionByName(gone, allowMissingColumns=True)


_APART = 17  # a prefix that makes other texts longer than the 16 bytes of a fingerprint


def _short(name: str) -> Column:
    """A fingerprint as the 16 bytes that its 32 digits stand for, in ``__short``; other texts stay whole, behind a prefix."""
    other = F.concat(F.lit(bytes(_APART)), col(name).cast("binary"))
    return F.coalesce(F.when(col(name).rlike("^[0-9a-f]{32}\\z"), F.unhex(col(name))), other).alias("__short")


def _long(name: str) -> Column:
    """The text that :func:`_short` was made of."""
    other = F.expr(f"substring({name}, {_APART + 1})").cast("string")
    return F.when(F.length(name) == 16, F.lower(F.hex(name))).otherwise(other)


def hash_cdc(current: DataFrame, previous: DataFrame, now: Any, counted: bool = False) -> DataFrame:
    """Change tags for a result without a key, by row fingerprint.

    Not in ``previous``: INSERT at ``now``. In both: INSERT with the old times. Only in ``previous``: DELETE, with its
    old timestamp, last updated at ``now``.

    A fingerprint may repeat without limit in either version, so the side that can repeat always streams through the
    join (where skewed partitions are split) against fingerprints made unique before the shuffle. All are shuffled as 16 bytes.

    ``counted`` compares numbers of copies as well: of three equal rows that become one, one stays and two are DELETE; of one that
    becomes three, two are INSERT at ``now``. The copies of a fingerprint share the earliest of its old times.
    """
    current = ensure_row_hash(current)
    previous = ensure_row_hash(previous)
    data = data_columns(current.columns)
    moment = as_timestamp(now)
    if counted:
        return _counted_cdc(current, previous, moment)

    old = previous.select(*[col(c) for c in data if c in previous.columns], col(TIMESTAMP), col(LAST_UPDATED), _short(HASH_COLUMN))
    times = (
        old.select(F.col("__short").alias("__ref"), col(TIMESTAMP), col(LAST_UPDATED))
        .groupBy(*apart_by(["__ref"]))
        .agg(F.min(col(TIMESTAMP)).alias("__ts"), F.min(col(LAST_UPDATED)).alias("__lu"))
    )
    new = current.select(*[col(c) for c in data], _short(HASH_COLUMN))
    found = new.join(times, F.col("__short") == col("__ref"), "left")
    known = col("__ref").isNotNull()
    present = found.select(
        *[col(c) for c in data],
        _long("__short").alias(HASH_COLUMN),
        F.lit("INSERT").alias(OPERATION),
        F.when(known, col("__ts")).otherwise(moment).alias(TIMESTAMP),
        F.when(known, col("__lu")).otherwise(moment).alias(LAST_UPDATED),
    )
    refs = new.select(F.col("__short").alias("__ref")).select(*apart_by(["__ref"])).dropDuplicates()
    gone = old.join(refs, F.col("__short") == col("__ref"), "left_anti").select(
        *[col(c) for c in data if c in previous.columns],
        _long("__short").alias(HASH_COLUMN),
        F.lit("DELETE").alias(OPERATION),
        col(TIMESTAMP),
        moment.alias(LAST_UPDATED),
    )
    return present.unionByName(gone, allowMissingColumns=True)


def first_refresh(current: DataFrame, now: Any) -> DataFrame:
    """Tags for a derived result that has no earlier version: every row is an INSERT."""
    return tag(ensure_row_hash(current), "INSERT", now)


def _resolves(df: DataFrame, order: str | Column) -> bool:
    """Whether all columns that the order names are there."""
    try:
        df.orderBy(col(order) if isinstance(order, str) else order)
    except AnalysisException as error:
        if not (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            raise
        return False
    return True


def _old(name: str) -> str:
    return f"__old {name}"
