"""Whitening of embeddings with refined eigenvectors.

Entries become whole numbers on a fine grid, so that counts, sums and the covariance of the whole table are exact: tasks add up
products of numbers centred at a whole number near the mean, and the rest of the centring is a fraction with divisor ``n``.

The covariance's eigenvectors are first found in single precision. Iterations of Ogita and Aishima, which are matrix products in
extended precision, correct them until nothing changes. Pairs of eigenvalues that lie too close for the correction are only made
orthogonal; each such cluster is then solved by itself, as a small matrix shifted by its mean eigenvalue, and the corrections run
again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches

SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 61)  # entries beyond are set to this on the grid
COMPONENTS = 8
GROUPS = 64  # of partial results that are merged at once
ROWS = 4096  # of a batch


def on_grid(vectors: np.ndarray) -> np.ndarray:
    """``floor(1024 * c) + 100000`` of each entry."""
    return np.floor(np.clip(vectors * SCALE, -LARGEST, LARGEST)).astype(np.int64) + SHIFT


def _by_length(vectors: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    sizes = np.array([len(v) for v in vectors])
    for size in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == size)
        yield at, on_grid(np.array([np.asarray(vectors.iloc[i], dtype=np.float64) for i in at]))


def _summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows and sums per length and dimension of a task."""
    sums: dict[int, list] = {}
    for batch in batches:
        for _, x in _by_length(batch["vector"]):
            n, s = sums.get(x.shape[1], (0, 0))
            sums[x.shape[1]] = [n + len(x), s + _column_sums(x)]
    for size, (n, s) in sums.items():
        yield pd.DataFrame({"size": size, "i": np.arange(size, dtype=np.int32), "n": n, "total": [str(v) for v in s]})


def _column_sums(x: np.ndarray) -> np.ndarray:
    """Exact, as Python's whole numbers."""
    if np.abs(x).max(initial=0) < 2**62 // max(len(x), 1):
        return x.sum(axis=0).astype(object)
    return x.astype(object).sum(axis=0)


def _products(x: np.ndarray) -> np.ndarray:
    """Exact sums of the products of columns."""
    if float(np.abs(x).max(initial=0)) ** 2 * len(x) < 2**53:
        return (x.T.astype(np.float64) @ x.astype(np.float64)).astype(np.int64).astype(object)
    wide = x.astype(object)
    return wide.T @ wide


def _moments(centres: dict[int, np.ndarray]):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, x in _by_length(batch["vector"]):
                size = x.shape[1]
                sums[size] = sums.get(size, 0) + _products(x - centres[size])
        for size, total in sums.items():
            i, j = np.triu_indices(size)
            yield pd.DataFrame({"size": size, "i": i.astype(np.int32), "j": j.astype(np.int32), "total": [str(v) for v in total[i, j]]})

    return rows


# --- eigenvectors ----------------------------------------------------------------------------------------------------


def _corrected(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One iteration: better vectors, their eigenvalues, and the distance below which two of those count as close."""
    one = np.eye(len(a), dtype=a.dtype)
    r = one - x.T @ x
    s = x.T @ a @ x
    value = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(value)
    # The two norms shrink with the error; rounding stays.
    close = 2 * (np.abs(off).sum(axis=1).max() + np.abs(value).max() * np.abs(r).sum(axis=1).max())
    close = max(close, 64 * len(a) * np.finfo(a.dtype).eps * np.abs(value).max())
    gap = value[None, :] - value[:, None]
    far = np.abs(gap) > close
    e = np.where(far, (s + value[None, :] * r) / np.where(far, gap, 1), r / 2)
    return x + x @ e, value, float(close)


def eigenvectors(a: np.ndarray, depth: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix, in extended precision.

    Starts from single precision. Vectors of an eigenvalue that repeats to the last bit are any orthonormal ones of its space.
    """
    a = (a.astype(np.longdouble) + a.T.astype(np.longdouble)) / 2
    size = np.abs(a).max(initial=0)
    if size == 0:
        return np.zeros(len(a), np.longdouble), np.eye(len(a), dtype=np.longdouble)
    a = a / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    tiny = np.finfo(np.longdouble).eps

    def settled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        before = np.inf
        for _ in range(30):
            new, value, close = _corrected(a, x)
            change = np.abs(new - x).max()
            x = new
            if change < 16 * tiny or (change >= before / 2 and change < 1e-15):
                break
            before = change
        return x, value, close

    x, value, close = settled(x)
    order = np.argsort(-value, kind="stable")
    x, value = x[:, order], value[order]
    starts = [0, *(np.flatnonzero(value[:-1] - value[1:] > close) + 1), len(value)]
    solved = False
    for begin, end in zip(starts, starts[1:], strict=False):
        if end - begin < 2 or depth > 4:
            continue
        own = x[:, begin:end]
        middle = value[begin:end].mean()
        small = own.T @ (a @ own - middle * own)
        if np.abs(small).max() > 16 * len(a) * tiny:
            x[:, begin:end] = own @ eigenvectors(small, depth + 1)[1]
            solved = True
    if solved:  # the clusters' vectors are apart now; what is left are errors against the others
        x = _between(a, x, starts)
    for _ in range(2):
        x = x + x @ ((np.eye(len(a)) - x.T @ x) / 2)
    x = x / np.sqrt((x * x).sum(axis=0))
    value = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-value, kind="stable")
    return value[order] * size, x[:, order]


def _between(a: np.ndarray, x: np.ndarray, starts: list[int]) -> np.ndarray:
    """Corrections between clusters; within one the vectors are only made orthogonal."""
    cluster = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    apart = cluster[None, :] != cluster[:, None]
    for _ in range(3):
        r = np.eye(len(a)) - x.T @ x
        s = x.T @ a @ x
        value = np.diag(s) / (1 - np.diag(r))
        gap = value[None, :] - value[:, None]
        far = apart & (gap != 0)
        x = x + x @ np.where(far, (s + value[None, :] * r) / np.where(far, gap, 1), r / 2)
    return x


# --- the operator ----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitener:
    """What is known of the vectors of one length: of its square in size, whatever the number of rows."""

    n: int
    centre: np.ndarray  # whole numbers near the means
    rest: list[int]  # sums less n times the centre
    vectors: np.ndarray  # by component
    values: np.ndarray
    explained: np.ndarray

    def whitened(self, x: np.ndarray) -> np.ndarray:
        means = np.array([float(Fraction(r, self.n)) for r in self.rest])
        z = ((x - self.centre) - means) @ self.vectors
        root = np.sqrt(self.values)
        return np.divide(z, root, out=np.zeros_like(z), where=root > 0)

    def deviations(self, x: np.ndarray) -> list[int]:
        y = x - self.centre
        most = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.rest), default=0)
        if most * most * x.shape[1] < 2**63:
            d = self.n * y - np.array(self.rest, dtype=np.int64)
            return (d * d).sum(axis=1).tolist()
        d = self.n * y.astype(object) - np.array(self.rest, dtype=object)
        return (d * d).sum(axis=1).tolist()


def covariance(n: int, rest: list[int], products: np.ndarray) -> np.ndarray:
    """From exact sums, rounded once per entry to extended precision."""
    total = np.array(products, dtype=object) * n - np.outer(np.array(rest, dtype=object), np.array(rest, dtype=object))
    out = np.zeros(total.shape, dtype=np.longdouble)
    for i, row in enumerate(total):
        for j, value in enumerate(row):
            fraction = Fraction(int(value), n * n)
            high = float(fraction)
            out[i, j] = np.longdouble(high) + np.longdouble(float(fraction - Fraction(high)))
    return out


def train(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Whitener]:
    """A whitener per length of vectors; ``vectors`` has ``vector``, arrays of finite doubles.

    Two passes of sums that Spark merges per dimension and per pair of dimensions. The driver gets a row per pair, so memory and
    work there depend on the length alone.
    """
    sums = vectors.select("vector").mapInPandas(_summed, "size int, i int, n long, total string")
    exact = F.col("total").cast("decimal(38,0)")
    rows = sums.groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum(exact).alias("total")).collect()
    counts = {r["size"]: r["n"] for r in rows}
    totals = {k: [0] * k for k in counts}
    for r in rows:
        totals[r["size"]][r["i"]] = int(r["total"])
    centres = {k: np.array([round(Fraction(t, counts[k])) for t in totals[k]], dtype=np.int64) for k in counts}
    moments = vectors.select("vector").mapInPandas(_moments(centres), "size int, i int, j int, total string")
    products = {k: np.zeros((k, k), dtype=object) for k in counts}
    for r in moments.groupBy("size", "i", "j").agg(F.sum(exact).alias("total")).collect():
        products[r["size"]][r["i"], r["j"]] = products[r["size"]][r["j"], r["i"]] = int(r["total"])
    out = {}
    for k, n in counts.items():
        rest = [t - n * int(c) for t, c in zip(totals[k], centres[k], strict=True)]
        v = covariance(n, rest, products[k])
        values, axes = eigenvectors(v)
        trace = np.trace(v)
        # An eigenvalue that is nothing but rounding is none.
        values = np.where(values > 256 * k * np.finfo(np.longdouble).eps * np.abs(values).max(initial=0), values, 0)
        top = min(components, k)
        share = (values[:top] / trace if trace > 0 else values[:top]).astype(np.float64)
        out[k] = Whitener(n, centres[k], rest, axes[:, :top].astype(np.float64), values[:top].astype(np.float64), share)
    return out


def _merged(parts: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Count, mean and sum of centred products of several parts together."""
    n, mean, square = parts[0]
    for m, other, more in parts[1:]:
        step = other - mean
        square = square + more + np.outer(step, step) * (n * m / (n + m))
        mean = mean + step * (m / (n + m))
        n += m
    return n, mean, square


def _spread(whiteners) -> object:
    """Count, means and centred products of the whitened rows of a task, per length."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple] = {}
        for batch in batches:
            for _, x in _by_length(batch["vector"]):
                w = whiteners.value[x.shape[1]].whitened(x)
                mean = w.mean(axis=0)
                part = len(w), mean, (w - mean).T @ (w - mean)
                held[x.shape[1]] = _merged([held[x.shape[1]], part]) if x.shape[1] in held else part
        for size, (n, mean, square) in held.items():
            yield pd.DataFrame({"size": [size], "n": [n], "mean": [mean], "square": [square.ravel()]})

    return rows


STATE = "size int, n long, mean array<double>, square array<double>"


def _merged_rows(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.iloc[np.argsort([tuple(m) for m in rows["mean"]], axis=0)[:, 0]] if len(rows) > 1 else rows
    parts = [(r.n, np.asarray(r.mean), np.asarray(r.square).reshape(len(r.mean), -1)) for r in rows.itertuples()]
    n, mean, square = _merged([(int(n), m, s) for n, m, s in parts])
    return pd.DataFrame({"size": [int(rows["size"].iloc[0])], "n": [n], "mean": [mean], "square": [square.ravel()]})


def identity_errors(vectors: DataFrame, whiteners: dict[int, Whitener]) -> dict[int, float]:
    """Per length, the largest entry of the whitened rows' covariance less the identity, over components with a spread.

    Measured over all rows: tasks give centred sums, which are merged in groups and then on the driver.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(whiteners)
    parts = vectors.select("vector").mapInPandas(_spread(shared), STATE)
    grouped = parts.withColumn("group", F.pmod(F.xxhash64("n", "mean"), F.lit(GROUPS))).groupBy("size", "group")
    out = {k: 0.0 for k in whiteners}
    states: dict[int, list] = {}
    for r in grouped.applyInPandas(_merged_rows, STATE).collect():
        size = len(r["mean"])
        states.setdefault(r["size"], []).append((r["n"], np.array(r["mean"]), np.array(r["square"]).reshape(size, size)))
    for k, found in states.items():
        n, _, square = _merged(sorted(found, key=lambda s: tuple(s[1])))
        real = whiteners[k].values > 0
        gap = np.abs(square / n - np.eye(len(square)))[np.ix_(real, real)]
        out[k] = float(gap.max(initial=0.0))
    return out


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Each row's whitened coordinates, one row per component.

    Takes ``vec_id, embedding``; other columns are ignored. Returns ``vec_id, component, n, deviation, whitened, explained,
    identity_error``; ``deviation`` is decimal(38,0), NULL beyond its range. A vector that is NULL or has NULL or non-finite
    entries is left out; repeated rows and NULL ids stay. Vectors of different length have no common covariance: each length is a
    fit list of its own. A vector shorter than ``components`` has as many components as entries, an empty one no row. A component
    without spread (one row, equal rows) has coordinates of 0 and does not count for the error. Entries beyond 2^61 on the grid
    are set to it. Components of equal eigenvalues, and the sign of each, are arbitrary but the same for all rows. An empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS))
    base = vectors.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    base = base.where(F.coalesce(fine, F.lit(False)) & (F.size("vector") > 0))
    whiteners = train(base, components)
    errors = identity_errors(base, whiteners)
    shared = spark.sparkContext.broadcast((whiteners, errors))

    @F.pandas_udf("n long, deviation string, error double, parts array<struct<whitened:double,explained:double>>")
    def projected(column: pd.Series) -> pd.DataFrame:
        known, errors = shared.value
        out = [None] * len(column)
        for at, x in _by_length(column):
            own = known[x.shape[1]]
            deviations, w = own.deviations(x), own.whitened(x)
            share = own.explained.tolist()
            for i, d, row in zip(at, deviations, w.tolist(), strict=True):
                parts = [{"whitened": a, "explained": b} for a, b in zip(row, share, strict=True)]
                out[i] = (own.n, str(d), errors[x.shape[1]], parts)
        return pd.DataFrame(out, columns=["n", "deviation", "error", "parts"])

    found = base.select("vec_id", projected("vector").alias("p"))
    rows = found.select("vec_id", "p.n", "p.deviation", "p.error", F.posexplode("p.parts").alias("at", "part"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        "n",
        F.col("deviation").try_cast("decimal(38,0)").alias("deviation"),
        "part.whitened",
        "part.explained",
        F.col("error").alias("identity_error"),
    )
