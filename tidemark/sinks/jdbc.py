"""Writing tables to a database, in parallel batches."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import cut_lineage
from ..sources.jdbc import table_name

# Fixed value: rows per insert batch.
BATCH_SIZE = 1000
# End of fixed values.


def write_options(
    url: str, table: str, default_schema: str | None = "public", batch_size: int = BATCH_SIZE
) -> dict[str, str]:
    return {"url": url, "dbtable": table_name(table, default_schema), "batchsize": str(batch_size)}


def append_jdbc(df: DataFrame, options: dict[str, str]) -> None:
    """Insert rows; the table is created if it is not there."""
    df.write.format("jdbc").options(**options).mode("append").save()


def replace_jdbc(df: DataFrame, options: dict[str, str]) -> None:
    """Make ``df`` the content of the table, keeping its definition.

    ``df`` may read the table it replaces: it is written to the shared folder before the table is cleared, where it
    also survives a failed load.
    """
    staged = cut_lineage(df)
    staged.write.format("jdbc").options(**options).option("truncate", True).mode("overwrite").save()
