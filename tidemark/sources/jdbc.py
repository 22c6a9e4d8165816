"""Scans of database tables and queries. The driver jar comes from the caller's ``spark.jars``."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the statement timeout of a source database, in seconds.
STATEMENT_TIMEOUT_S = 3600
# End of fixed values.


class Slices(NamedTuple):
    """Parallel read: ``count`` ranges of ``column`` between the bounds; rows outside them are read as well."""

    column: str
    lower: str | int
    upper: str | int
    count: int


def table_name(table: str, default_schema: str | None = "public") -> str:
    """``schema.table`` as it is, else the table in the default schema if there is one."""
    return table if "." in table or not default_schema else f"{default_schema}.{table}"


def jdbc_options(
    url: str,
    table: str | None = None,
    query: str | None = None,
    default_schema: str | None = "public",
    partition: Slices | None = None,
    timeout_s: int = STATEMENT_TIMEOUT_S,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options. A query wins over a table and is a derived table, so that it can be read in slices too."""
    if query:
        relation = f"({query.strip().rstrip(';')}) source_query"
    elif table:
        relation = table_name(table, default_schema)
    else:
        raise ValueError("a database source needs a table or a query")
    options = {
        "url": url,
        "dbtable": relation,
        "queryTimeout": str(timeout_s),
        "fetchsize": str(fetch_size),
        "preferTimestampNTZ": "true",
    }
    if partition:
        options |= {
            "partitionColumn": partition.column,
            "lowerBound": str(partition.lower),
            "upperBound": str(partition.upper),
            "numPartitions": str(partition.count),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, properties: dict[str, str] | None = None, **source) -> DataFrame:
    """Scan a table or query; arguments are those of :func:`jdbc_options`, ``properties`` hold credentials and driver.

    Pass ``default_schema=None`` for a database whose default comes from the connection. Filters and column choice
    are pushed into the database.
    """
    options = jdbc_options(url, **source) | (properties or {})
    return spark.read.format("jdbc").options(**options).load()
