"""Bringing source rows into a target table. Each function returns the new target; none deletes.

NULL in a key never matches, as in SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import col, data_columns, row_hash
from .keys import apart_by, dedup_by_key, distinct_keys

CHANGE = "__change"


def _key_side(target: DataFrame, keys: Sequence[str]) -> DataFrame:
    return distinct_keys(target, keys).select(*[col(k).alias(_key(k)) for k in keys])


def _key_side_of_skewed(target: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = target.select(*[col(k).alias(_key(k)) for k in keys])
    return renamed.groupBy(*apart_by(renamed.columns)).agg(F.lit(True).alias("__known"))


def _on_keys(keys: Sequence[str]) -> Column:
    return reduce(and_, [col(k) == col(_key(k)) for k in keys])


def missing_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks."""
    return source.join(_key_side_of_skewed(target, keys), _on_keys(keys), "left_anti")


def existing_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target has."""
    return source.join(_key_side_of_skewed(target, keys), _on_keys(keys), "left_semi")


def append(target: DataFrame | None, source: DataFrame) -> DataFrame:
    """All rows of both; columns the source lacks are NULL, columns the target lacks are left out."""
    if target is None:
        return source
    return target.unionByName(_as_target(source, target), allowMissingColumns=True)


def reload(source: DataFrame, keys: Sequence[str], order_by=None) -> DataFrame:
    """The content of a target cleared and loaded again: one source row per key."""
    return dedup_by_key(source, keys, order_by)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], order_by=None) -> DataFrame:
    """Insert new keys and update known ones; if there is nothing but keys, known ones are left alone.

    ``target`` should be unique by key, as the conflict rule of a database demands; if it is not, every row of a key is
    updated, and none is lost. Columns only the target has keep their value. One full outer join.
    """
    rows = _as_target(dedup_by_key(source, keys, order_by), target)
    if set(rows.columns) <= set(keys):
        return append(target, missing_rows(rows, target, keys))
    return _overlaid(target, rows, keys, "full_outer")


def merge_changes(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by=None, changed_only: bool = False
) -> DataFrame:
    """What :func:`reconcile` does to the target: one source row per key with its operation in ``__change``.

    ``changed_only`` leaves out updates that would not change a shared column; then ``target`` must be unique by key.
    """
    rows = dedup_by_key(source, keys, order_by)
    if changed_only:
        shared = [c for c in data_columns(source.columns) if c in target.columns]
        rows = rows.withColumn("__hash", row_hash(rows, shared))
        known = target.select(
            *[col(k).alias(_key(k)) for k in keys],
            row_hash(target, shared).alias("__known_hash"),
            F.lit(True).alias("__known"),
        )
    else:
        known = _key_side(target, keys).withColumn("__known", F.lit(True))
    joined = rows.join(known, _on_keys(keys), "left")
    if changed_only:
        joined = joined.where("__known IS NULL OR __hash <> __known_hash")
    operation = F.when(col("__known").isNull(), "INSERT").otherwise("UPDATE")
    return joined.select(*[col(c) for c in source.columns], operation.alias(CHANGE))


def reconcile(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order_by=None,
    changed_only: bool = False,
    unique_target: bool = False,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Insert missing rows and update existing ones: the new target and the changes that led to it.

    Without ``unique_target`` a key may repeat in the target without limit, each of its rows is updated, and the
    target streams through a join that splits skewed partitions. With it, one full outer join does.

    Updates and inserts come from one match of the source rows with the target's keys. ``stage`` (see
    :func:`~tidemark.session.staging`) writes that match, so that the source is read once.
    """
    matched = merge_changes(target, source, keys, order_by)
    matched = stage(matched) if stage else matched
    changes = merge_changes(target, source, keys, order_by, changed_only) if changed_only else matched
    # A scan, or rows made unique by other groups than the join's: either way both sides of the join are plain shuffles.
    rows = matched if stage else dedup_by_key(source, keys, order_by, apart=not unique_target)
    rows = _as_target(rows.drop(CHANGE), target)
    if unique_target:
        return _overlaid(target, rows, keys, "full_outer"), changes
    inserts = matched.where(col(CHANGE) == "INSERT").drop(CHANGE)
    return append(_overlaid(target, rows, keys, "left"), inserts), changes


def _overlaid(target: DataFrame, rows: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """``target`` with the values of ``rows`` where the key matches."""
    changed = [c for c in rows.columns if c not in keys]
    picked = rows.select(
        *[col(k).alias(_key(k)) for k in keys], *[col(c).alias(_new(c)) for c in changed], F.lit(True).alias("__found")
    )
    found = col("__found").isNotNull()

    def value(name: str) -> Column:
        if name in keys or name in changed:
            new = col(_key(name) if name in keys else _new(name))
            return F.when(found, new).otherwise(col(name)).alias(name)
        return col(name)

    return target.join(picked, _on_keys(keys), how).select(*[value(c) for c in target.columns])


def _as_target(source: DataFrame, target: DataFrame) -> DataFrame:
    return source.select(*[col(c) for c in source.columns if c in target.columns])


def _key(name: str) -> str:
    return f"__key {name}"


def _new(name: str) -> str:
    return f"__new {name}"
