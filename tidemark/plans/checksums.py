"""Checksums of a stored table as a tree over the prefixes of its rows' fingerprints, and differences of two tables by them.

Layout: ``<base>/rows``, the table sorted by fingerprint, and ``<base>/tree/level=<digits>``, one row per prefix of that many digits with the
number of its rows and the sum of their fingerprints. Two trees are compared from the top; below a prefix whose entries are equal
nothing is read, neither of the trees nor of the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import HASH_COLUMN, col
from ..operators.projection import ensure_row_hash
from ..sinks.files import SNAPSHOT_CODEC

DEPTH = 4  # digits of the longest prefixes: 65,536 of them
STEP = 2  # digits from one level to the next
RANGES = 512  # prefixes that are pushed to the scan one by one

_PARTS = tuple(range(1, 31, 5))  # fingerprints are added up in parts of five digits


def _summed(rows: DataFrame, *keys: Column) -> DataFrame:
    parts = [F.sum(F.conv(F.substring(col(HASH_COLUMN), at, 5), 16, 10).cast("bigint")).alias(f"p{at}") for at in _PARTS]
    return rows.groupBy(*keys).agg(F.count("*").alias("row_count"), *parts)


def write_checksum_tree(df: DataFrame, base: str, depth: int = DEPTH, partitions: int | None = None) -> None:
    """Store a table sorted by fingerprint, and its tree.

    ``depth`` should make the longest prefixes hold some thousands of rows. The rows are dealt out by fingerprint ranges, so equal
    rows lie together; their sums are taken from the written files, upper levels from lower ones. An earlier copy is replaced.
    """
    if depth < STEP or depth % STEP:
        raise ValueError(f"depth is a multiple of {STEP}: {depth}")
    spark, base = df.sparkSession, base.rstrip("/")
    hashed = ensure_row_hash(df)
    by_ref = [col(HASH_COLUMN)]
    dealt = hashed.repartitionByRange(partitions, *by_ref) if partitions else hashed.repartitionByRange(*by_ref)
    dealt.sortWithinPartitions(*by_ref).write.mode("overwrite").option("compression", SNAPSHOT_CODEC).parquet(f"{base}/rows")
    stored = spark.read.schema(hashed.schema).parquet(f"{base}/rows")
    _summed(stored, F.substring(col(HASH_COLUMN), 1, depth).alias("prefix")).write.mode("overwrite").parquet(_level(base, depth))
    for level in range(depth - STEP, 0, -STEP):
        below = spark.read.parquet(_level(base, level + STEP))
        sums = [F.sum(c).alias(c) for c in below.columns if c != "prefix"]
        above = below.groupBy(F.substring("prefix", 1, level).alias("prefix")).agg(*sums)
        above.write.mode("overwrite").parquet(_level(base, level))


def _level(base: str, digits: int) -> str:
    return f"{base.rstrip('/')}/tree/level={digits:02d}"


def differing_prefixes(spark: SparkSession, left: str, right: str, depth: int = DEPTH) -> DataFrame:
    """The longest prefixes whose sums differ, compared from the top: of each level only the children of differing parents."""
    open_ = None
    for level in range(STEP, depth + 1, STEP):
        sides = [spark.read.parquet(_level(base, level)) for base in (left, right)]
        if open_ is not None:
            parent = F.substring("prefix", 1, level - STEP)
            sides = [s.join(open_.withColumnRenamed("prefix", "above"), parent == F.col("above"), "left_semi") for s in sides]
        values = [c for c in sides[0].columns if c != "prefix"]
        other = sides[1].select(F.col("prefix").alias("p"), *[F.col(c).alias(f"o {c}") for c in values])
        met = sides[0].join(other, F.col("prefix") == F.col("p"), "full_outer")
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"o {c}")) for c in values])
        open_ = met.where(~same).select(F.coalesce("prefix", "p").alias("prefix"))
    return open_


def differing_rows(spark: SparkSession, base: str, prefixes: DataFrame) -> DataFrame:
    """The stored rows below some prefixes. Few prefixes reach the scan as ranges of fingerprints, many become a semi-join."""
    rows = spark.read.parquet(f"{base.rstrip('/')}/rows")
    found = sorted(r[0] for r in prefixes.limit(RANGES + 1).collect())
    if not found:
        return rows.limit(0)
    if len(found) > RANGES:
        return rows.join(prefixes, F.substring(col(HASH_COLUMN), 1, len(found[0])) == F.col("prefix"), "left_semi")
    return rows.where(reduce(lambda a, b: a | b, [(col(HASH_COLUMN) >= p) & (col(HASH_COLUMN) < p + "g") for p in found]))


def checksum_diff(spark: SparkSession, left: str, right: str, depth: int = DEPTH) -> DataFrame:
    """``$_ref, left_rows, right_rows`` of the fingerprints that two stored tables hold in different numbers.

    Both were written by :func:`write_checksum_tree` with this ``depth``. Equal tables give no rows and read the top level alone.
    """
    prefixes = differing_prefixes(spark, left, right, depth)
    counts = [
        differing_rows(spark, base, prefixes).groupBy(col(HASH_COLUMN).alias(f"{side} ref")).agg(F.count("*").alias(f"{side}_rows"))
        for side, base in (("left", left), ("right", right))
    ]
    met = counts[0].join(counts[1], F.col("left ref") == F.col("right ref"), "full_outer").select(
        F.coalesce("left ref", "right ref").alias(HASH_COLUMN),
        F.coalesce("left_rows", F.lit(0)).alias("left_rows"),
        F.coalesce("right_rows", F.lit(0)).alias("right_rows"),
    )
    return met.where(F.col("left_rows") != F.col("right_rows"))
