"""Column mapping, casting, fingerprint and snapshot tags."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    HASH_COLUMN,
    LAST_UPDATED,
    OPERATION,
    TIMESTAMP,
    as_timestamp,
    col,
    data_columns,
    is_date_type,
    row_hash,
    safe_cast,
    zero_date_to_null,
)

Spec = Mapping[str, Any]


def _declared(source: Column, source_type: T.DataType, type_name: str | None) -> Column:
    if isinstance(source_type, T.StringType) and is_date_type(type_name):
        source = zero_date_to_null(source, type_name)
    return zero_date_to_null(safe_cast(source, type_name, source_type), type_name)


def _field_types(df: DataFrame) -> dict[str, T.DataType]:
    types: dict[str, T.DataType] = {}
    for field in df.schema.fields:
        types[field.name] = field.dataType
        types.setdefault(field.name.lower(), field.dataType)
    return types


def apply_field_mappings(
    df: DataFrame, mappings: Sequence[Spec], schema: Sequence[Spec] | None = None, exact: bool = False
) -> DataFrame:
    """Keep the mapped columns under their target names, cast to the type ``schema`` declares for the target.

    ``exact`` matches target and schema names by letter case too, as database sources do. A target the schema
    does not list keeps its type.
    """
    fold = (lambda name: name) if exact else str.lower
    declared: dict[str, str | None] = {}
    for field in schema or []:
        declared.setdefault(fold(field["name"]), field.get("type"))
    types = _field_types(df)
    out = []
    for mapping in mappings:
        source = mapping["source"]
        source_type = types.get(source) or types[source.lower()]
        value = _declared(col(source), source_type, declared.get(fold(mapping["target"])))
        out.append(value.alias(mapping["target"]))
    return df.select(*out)


def apply_schema(df: DataFrame, schema: Sequence[Spec]) -> DataFrame:
    """Keep the declared columns, cast to their declared types."""
    return apply_field_mappings(df, [{"source": f["name"], "target": f["name"]} for f in schema], schema)


def mappings_from_schema(schema: Spec | Sequence[Spec]) -> list[dict[str, str]]:
    """Mappings hidden in a nested schema (or several): its children name a source column and a target."""
    parents = [schema] if isinstance(schema, Mapping) else schema
    children = (child for parent in parents for child in parent.get("children") or [])
    return [
        {"source": child["sourceColumn"], "target": child["name"]}
        for child in children
        if child.get("sourceColumn") and child.get("name")
    ]


def project(
    df: DataFrame,
    mappings: Sequence[Spec] | None = None,
    schema: Sequence[Spec] | None = None,
    exact: bool = False,
) -> DataFrame:
    """Mappings if there are any, else the declared schema, else all columns as they are."""
    if mappings:
        return apply_field_mappings(df, mappings, schema, exact)
    if schema:
        return apply_schema(df, schema)
    return df


def with_row_hash(df: DataFrame, columns: Iterable[str] | None = None, out: str = HASH_COLUMN) -> DataFrame:
    """Add the row fingerprint over ``columns`` (all data columns when not given)."""
    chosen = list(columns) if columns is not None else data_columns(df.columns)
    return df.withColumn(out, row_hash(df, chosen))


def ensure_row_hash(df: DataFrame) -> DataFrame:
    return df if HASH_COLUMN in df.columns else with_row_hash(df)


def tag(df: DataFrame, operation: Column | str, now: Any, last_updated: Column | None = None) -> DataFrame:
    """Data columns, fingerprint and the three tags, in the stored order."""
    moment = as_timestamp(now)
    return df.select(
        *[col(c) for c in data_columns(df.columns)],
        col(HASH_COLUMN),
        (F.lit(operation) if isinstance(operation, str) else operation).alias(OPERATION),
        moment.alias(TIMESTAMP),
        (moment if last_updated is None else last_updated).alias(LAST_UPDATED),
    )


def tag_snapshot(df: DataFrame, now: Any) -> DataFrame:
    """Tag every row as part of a plain snapshot taken at ``now``."""
    return tag(ensure_row_hash(df), "SNAPSHOT", now)


def snapshot(
    df: DataFrame,
    mappings: Sequence[Spec] | None = None,
    schema: Sequence[Spec] | None = None,
    now: Any = None,
    exact: bool = False,
) -> DataFrame:
    """Project, fingerprint and tag a source: the sync without key or without an earlier version."""
    return tag_snapshot(with_row_hash(project(df, mappings, schema, exact)), now)
