"""Helpers shared by the operators: text columns, span digests, batches, ordered slices."""

from __future__ import annotations

import hashlib
import tempfile
import zipfile
from collections.abc import Iterable
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows per Arrow batch. Texts may be long, so a batch is kept small.
BATCH_ROWS = 256


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, in rows and in bytes, and let the workers import this package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    _ship(spark)


def _ship(spark: SparkSession) -> None:
    """Send the package's code to the executors, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="tidemark-code-")) / "tidemark.zip"  # the driver serves it from there
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted((root / "tidemark").rglob("*.py")):
            out.write(file, file.relative_to(root))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


_SHIPPED: set[str] = set()


def text_of(name: str = "text") -> Column:
    """The column as text, NULL as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def span_text(spans: Iterable[tuple[str, int, int]]) -> str:
    """``kind:start:end`` of each span, joined by commas."""
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def code_points(text: str) -> np.ndarray:
    """The text's code points as an array."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finalizer of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def true_runs(mask: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values that are at least ``least`` long."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    keep = ends - starts >= least
    return starts[keep], ends[keep]


def slice_starts(df: DataFrame, key: str, slices: int) -> list[int]:
    """Values of a numeric column that cut the rows into about ``slices`` equal parts, ascending, at most ``slices``."""
    at = [i / slices for i in range(slices)]
    row = df.agg(F.percentile_approx(key, at, 10_000).alias("cuts")).first()
    return sorted(set(row["cuts"] or []))


def likely_among(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows whose numeric ``key`` is in ``ids`` (a column of the same name), and a few others.

    To be put before a join on the key, so that its shuffle moves little. The ids' hashes mark bits in 256 bitmaps of 4 KB;
    that is what is broadcast, however many ids there are. The more ids, the more other rows stay.
    """
    spread = F.pmod(F.xxhash64(key), F.lit(1 << 23))
    marked = ids.select(spread.alias("place")).groupBy(F.shiftright("place", 15).alias("mark_group"))
    marks = marked.agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit(32767))).alias("mark_bits")).coalesce(16)
    place = spread.bitwiseAND(F.lit(32767))
    byte = F.conv(F.hex(F.substring("mark_bits", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked_here = byte.bitwiseAND(F.pow(F.lit(2), place.bitwiseAND(F.lit(7))).cast("int")) != 0
    same = F.shiftright(spread, 15) == F.col("mark_group")
    return rows.join(F.broadcast(marks), same & marked_here).select(*[rows[c] for c in rows.columns])
