"""Counts and checksums of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import HASH_COLUMN, OPERATION, col, row_hash

# The operations a sync counts, and the checksum of a table without rows.
OPERATIONS = ("INSERT", "UPDATE", "DELETE", "NO_CHANGE", "SNAPSHOT")
EMPTY_CHECKSUM = "empty"
# End of fixed values.


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def operation_counts(cdc: DataFrame) -> DataFrame:
    """Rows per operation."""
    return cdc.groupBy(col(OPERATION)).agg(F.count("*").alias("row_count"))


def metric_columns() -> list[Column]:
    """Aggregates of a sync: all rows and rows per operation. Usable in ``agg`` and in ``observe``."""
    per_operation = [F.count_if(col(OPERATION) == o).alias(o.lower() + "_rows") for o in OPERATIONS]
    return [F.count("*").alias("rows"), *per_operation]


def sync_metrics(cdc: DataFrame, size_bytes: int | None = None, status: str = "completed") -> DataFrame:
    """One row on a sync: rows, rows per operation, stored bytes, status."""
    return cdc.agg(*metric_columns()).select(
        "*", F.lit(size_bytes).cast("bigint").alias("bytes"), F.lit(status).alias("status")
    )


def stored_bytes(df: DataFrame) -> DataFrame:
    """Bytes of the files ``df`` is read from."""
    files = df.select("_metadata.file_path", "_metadata.file_size").dropDuplicates(["file_path"])
    return files.agg(F.sum("file_size").alias("bytes"))


def table_checksum(df: DataFrame) -> DataFrame:
    """A checksum of all rows in any order, and their number.

    The row fingerprints are added up as two numbers of 15 hexadecimal digits, so tasks merge two sums instead of sorting
    all fingerprints in one place, and repeated rows count. Without a fingerprint column it is taken over all columns.
    """
    ref = col(HASH_COLUMN) if HASH_COLUMN in df.columns else row_hash(df, df.columns)
    # Each number in three parts of five digits: their sums stay in 64 bits for 2^43 rows, and are put together once.
    parts = {f"p{at}": F.conv(F.substring("ref", at, 5), 16, 10).cast("bigint") for at in range(1, 31, 5)}
    sums = df.select(ref.alias("ref")).agg(F.count("*").alias("row_count"), *[F.sum(v).alias(k) for k, v in parts.items()])

    def number(at: int):
        high, middle, low = (F.col(f"p{at + 5 * k}").cast("decimal(28,0)") for k in range(3))
        return high * F.lit(1 << 40) + middle * F.lit(1 << 20) + low

    sums = sums.select("row_count", number(1).cast("decimal(38,0)").alias("high"), number(16).cast("decimal(38,0)").alias("low"))
    joined = F.concat_ws("|", *[F.col(c).cast("string") for c in ("row_count", "high", "low")])
    return sums.select(
        F.when(F.col("row_count") == 0, EMPTY_CHECKSUM).otherwise(F.md5(joined)).alias("checksum"), "row_count"
    )
