"""Derived models: a query definition over named tables, run as Spark SQL."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..functions import data_columns, quote, sanitize_name, unique_names
from ..session import overridden
from .ranges import AT, BIN, LEVEL, binned_intervals, binned_points, has_order

# The kinds of definition and of join.
STRUCTURED_TYPES = ("join", "aggregation", "filter")
JOIN_TYPES = ("INNER", "LEFT", "RIGHT", "FULL")
# End of fixed values.

Definition = Mapping[str, Any]


def register_models(spark: SparkSession, models: Mapping[str, DataFrame]) -> dict[str, str]:
    """Make the models visible to SQL; returns the table name of each."""
    tables = {name: sanitize_name(name) for name in models}
    if len(set(tables.values())) != len(tables):
        raise ValueError(f"model names collide as table names: {sorted(tables)}")
    for name, df in models.items():
        df.createOrReplaceTempView(tables[name])
    return tables


@contextmanager
def _registered(spark: SparkSession, models: Mapping[str, DataFrame]) -> Iterator[None]:
    """Views of the models while a statement is bound, so that a later one cannot find them by chance. Views of the same
    name that were there before come back."""
    names = {sanitize_name(name) for name in models}
    hidden = {n: spark.table(n) for n in names if any(t.name == n and t.isTemporary for t in spark.catalog.listTables(pattern=n))}
    try:
        register_models(spark, models)
        yield
    finally:
        for name in names:
            if name in hidden:
                hidden[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def resolve_model(name: str, models: Iterable[str]) -> str:
    """The table a join means by ``name``: the model of that name, else the one model whose name contains it or
    is contained in it, else ``name`` itself. More than one such model is an error."""
    wanted = sanitize_name(name)
    tables = [sanitize_name(m) for m in models]
    if wanted in tables:
        return wanted
    near = [t for t in tables if wanted in t or t in wanted]
    if len(near) > 1:
        raise ValueError(f"join target {name!r} may mean any of {near}")
    return near[0] if near else wanted


def _join_clause(join: Mapping[str, Any], left: str, models: Sequence[str]) -> str:
    name = join.get("table") or join.get("model")
    if not name:
        raise ValueError(f"join without table or model: {dict(join)}")
    kind = str(join.get("type", "")).upper()
    if kind not in JOIN_TYPES:
        raise ValueError(f"join type must be one of {JOIN_TYPES}: {dict(join)}")
    right = resolve_model(name, models)
    on = join["on"]
    if not isinstance(on, str):
        if len(on) != 2:
            raise ValueError(f"a join on columns needs exactly two: {list(on)}")
        on = f"{left}.{quote(on[0])} = {right}.{quote(on[1])}"
    return f"{kind} JOIN {right} ON {on}"


_NAME = r"(?:(\w+)\s*\.\s*)?(\w+)"
_BETWEEN = re.compile(rf"\s*{_NAME}\s+BETWEEN\s+{_NAME}\s+AND\s+{_NAME}\s*", re.IGNORECASE)
_BOUNDS = re.compile(rf"\s*{_NAME}\s*>=?\s*{_NAME}\s+AND\s+{_NAME}\s*<=?\s*{_NAME}\s*", re.IGNORECASE)


def _range_of(on: str) -> list[tuple[str | None, str]] | None:
    """Value, lower and upper end of a condition that is nothing but one range between plain columns, else None."""
    if match := _BETWEEN.fullmatch(on):
        parts = match.groups()
    elif match := _BOUNDS.fullmatch(on):
        parts = match.groups()
        if parts[1] != parts[5] or (parts[0] or parts[4] or "").lower() != (parts[4] or parts[0] or "").lower():
            return None
        parts = (parts[0] or parts[4], *parts[1:4], *parts[6:])
    else:
        return None
    return [(table and table.lower(), name) for table, name in zip(parts[::2], parts[1::2], strict=True)]


def binned_ranges(definition: Definition, models: Mapping[str, DataFrame]) -> tuple[Definition, dict[str, DataFrame]]:
    """The definition and models with the first inner join on a range made an equality join of bins.

    That is a join whose condition is ``x BETWEEN a AND b`` or ``x >= a AND x < b`` (either end open or closed), where ``x`` is a
    column of the FROM model and the ends are columns of the joined one, or the other way round. The condition itself stays, so
    bins only spare the comparison of all pairs. Everything else is left as it is.
    """
    tables = {sanitize_name(name): name for name in models}
    joins = list(definition.get("joins") or [])
    left = sanitize_name(definition.get("from") or next(iter(models)))
    for at, join in enumerate(joins):
        found = _range_of(join["on"]) if isinstance(join.get("on"), str) else None
        if found is None or str(join.get("type", "")).upper() != "INNER" or left not in tables:
            continue
        right = resolve_model(join.get("table") or join.get("model") or "", list(models))
        if right not in tables or right == left:
            continue
        frames = {side: models[tables[side]] for side in (left, right)}

        def side_of(part: tuple[str | None, str]) -> str | None:
            table, name = part
            holders = [s for s, df in frames.items() if name in df.columns and table in (None, s)]
            return holders[0] if len(holders) == 1 and has_order(frames[holders[0]].schema[name].dataType) else None

        value, ends = side_of(found[0]), {side_of(found[1]), side_of(found[2])}
        if value is None or len(ends) != 1 or None in ends or value in ends:
            continue
        other = ends.pop()
        pieces, levels = binned_intervals(frames[other], found[1][1], found[2][1])
        points = binned_points(frames[value], found[0][1], levels)
        bins = " AND ".join(f"{value}.{quote(AT)}.{x} = {other}.{quote(y)}" for x, y in (("level", LEVEL), ("bin", BIN)))
        joins[at] = dict(join) | {"on": f"{bins} AND {join['on']}"}
        return dict(definition) | {"joins": joins}, dict(models) | {tables[other]: pieces, tables[value]: points}
    return definition, dict(models)


def build_sql(definition: Definition, models: Sequence[str]) -> str:
    """Spark SQL of a query definition over the tables of ``models``."""
    kind = definition.get("type")
    if kind == "custom" and definition.get("sql"):
        return definition["sql"]
    if kind not in STRUCTURED_TYPES:
        raise ValueError(f"unsupported query type: {kind!r}")
    if not definition.get("from") and not models:
        raise ValueError("a derived model needs a source model")
    left = sanitize_name(definition.get("from") or models[0])
    clauses = [f"SELECT {', '.join(definition.get('select') or ['*'])}", f"FROM {left}"]
    clauses += [_join_clause(join, left, models) for join in definition.get("joins") or []]
    if definition.get("where"):
        clauses.append(f"WHERE {definition['where']}")
    if definition.get("groupBy"):
        clauses.append(f"GROUP BY {', '.join(definition['groupBy'])}")
    if definition.get("orderBy"):
        clauses.append(f"ORDER BY {', '.join(definition['orderBy'])}")
    return "\n".join(clauses)


def _used_once(definition: Definition, models: Mapping[str, DataFrame]) -> bool:
    """Whether no model is joined twice; then a model's rows may be dealt out for one of the joins."""
    names = [sanitize_name(definition.get("from") or next(iter(models)))]
    names += [resolve_model(j.get("table") or j.get("model") or "", list(models)) for j in definition.get("joins") or []]
    kinds = {str(j.get("type", "")).upper() for j in definition.get("joins") or []}
    return len(set(names)) == len(names) and kinds <= {"INNER"}


def build_model(
    spark: SparkSession,
    definition: Definition | None,
    models: Mapping[str, DataFrame],
    double_quoted_identifiers: bool = False,
) -> DataFrame:
    """The rows of a derived model, without tags.

    System columns of the sources may be used in any clause but are not part of the result, and a column name that
    repeats is numbered (``v``, ``v_1``), so that the result can be stored. With ``double_quoted_identifiers`` the
    free SQL may write ``"name"`` for a column. An inner join on a range is binned, see :func:`binned_ranges`.
    """
    if not definition:
        raise ValueError("a derived model needs a query definition")
    if not models:
        raise ValueError("a derived model needs a source model")
    if definition.get("type") in STRUCTURED_TYPES and _used_once(definition, models):
        definition, models = binned_ranges(definition, models)
    sql = build_sql(definition, list(models))
    quoting = {"spark__sql__ansi__doubleQuotedIdentifiers": "true"} if double_quoted_identifiers else {}
    with _registered(spark, models), overridden(spark, **quoting):
        rows = spark.sql(sql)
    numbered = rows.toDF(*unique_names(rows.columns))
    return numbered.select(*[quote(c) for c in data_columns(numbered.columns)])
