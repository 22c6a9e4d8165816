"""Near duplicates of embeddings by randomly rotated binary codes.

A unit vector, rotated by random orthogonal matrices, is coded by the signs of its coordinates. The code of the first
rotation comes with a correction factor, the inner product of the vector and its own code: dividing by it makes the inner
product of a code with another, uncoded vector an unbiased estimate of the cosine, with a known spread. Bits sampled from
all codes make the buckets in which candidates meet. A candidate is dropped where the number of different bits or the
upper confidence bound of the estimate rules the threshold out; all others are recomputed exactly in double precision.

Equal vectors are one class and are coded once. Buckets over ``BLOCK`` classes are dealt out as pairs of blocks. A pair that
meets in several tables is taken in the first of them only, so that it is emitted once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mix64, small_batches
from tidemark.llm.graph import components
from tidemark.session import cut_lineage

BLOCK = 512
BUCKET = 8  # classes in a bucket, on average
MISS = 1e-3  # chance that a pair at the threshold shares no table
DEVIATIONS = 5.0  # of the number of different bits
ERROR = 4.0  # width of the estimate's confidence bound, in units of its spread
SEED = 11


def rotations(dimension: int) -> np.ndarray:
    """Random orthogonal matrices, at least 128 rows in all and at least four of them."""
    rng = np.random.default_rng(SEED + dimension)
    count = max(4, -(-128 // dimension))
    return np.stack([np.linalg.qr(rng.standard_normal((dimension, dimension)))[0] for _ in range(count)])


class Tables:
    """The bits that each table samples, for one dimension and number of bits."""

    def __init__(self, dimension: int, bits: int, threshold: float):
        self.rotations = rotations(dimension)
        self.width = len(self.rotations) * dimension
        agree = 1 - math.acos(threshold) / math.pi
        bits = min(bits, self.width)
        rng = np.random.default_rng(SEED)
        count = math.ceil(math.log(MISS) / math.log(1 - agree**bits))
        self.positions = np.stack([rng.choice(self.width, bits, replace=False) for _ in range(count)])
        spread = math.sqrt(self.width * agree * (1 - agree))
        self.most_different = int(self.width * (1 - agree) + DEVIATIONS * spread)
        numbers = mix64(np.arange(1, bits + count + 1, dtype=np.uint64))
        self.weights, self.starts = numbers[:bits], numbers[bits:]

    def signs(self, unit: np.ndarray) -> np.ndarray:
        """Bits of all rotations, one row per vector."""
        return np.concatenate([unit @ r.T for r in self.rotations], axis=1) >= 0

    def keys(self, signs: np.ndarray) -> np.ndarray:
        """One bucket key per vector and table."""
        dimension = np.uint64(self.rotations.shape[1])
        out = [
            mix64((signs[:, p] * self.weights).sum(axis=1, dtype=np.uint64) + start + dimension)
            for start, p in zip(self.starts, self.positions, strict=True)
        ]
        return np.stack(out, axis=1).view(np.int64)

    def first_shared(self, different: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Whether no table before ``table`` holds the pairs too; ``different`` has the bits in which they differ."""
        first = np.ones(len(different), dtype=bool)
        for t in range(int(table.max(initial=0))):
            open_ = np.flatnonzero(first & (table > t))
            if not len(open_):
                continue
            first[open_] = different[open_][:, self.positions[t]].any(axis=1)
        return first


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by the largest component first, so that squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _by_dimension(vectors: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    sizes = np.array([len(v) for v in vectors])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, np.array([np.asarray(vectors.iloc[i], dtype=np.float64) for i in at])


def _coded(bits: int, threshold: float):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables: dict[int, Tables] = {}
        for batch in batches:
            for at, vectors in _by_dimension(batch["vector"]):
                t = tables.setdefault(vectors.shape[1], Tables(vectors.shape[1], bits, threshold))
                unit = _unit(vectors)
                signs = t.signs(unit)
                factor = np.abs(unit @ t.rotations[0].T).sum(axis=1) / math.sqrt(unit.shape[1])
                codes = [row.tobytes() for row in np.packbits(signs, axis=1)]
                keys, ids = t.keys(signs), batch["id"].to_numpy()[at]
                count = keys.shape[1]
                yield pd.DataFrame(
                    {
                        "bucket": keys.ravel(),
                        "slot": np.tile(np.arange(count, dtype=np.int32), len(at)),
                        "id": np.repeat(ids, count),
                        "dimension": np.int32(unit.shape[1]),
                        "code": np.repeat(np.array(codes, dtype=object), count),
                        "factor": np.repeat(factor, count),
                    }
                )

    return rows


CODED = "bucket long, slot int, id long, dimension int, code binary, factor double"
PAIRED = "a long, b long, dimension int, code binary, factor double"


def _pairs(bits: int, threshold: float):
    """Candidate pairs of rows sorted by bucket and block pair; a bucket's rows may span batches."""

    def of(rows: pd.DataFrame, tables: dict[int, Tables]) -> pd.DataFrame:
        group = rows["group"].to_numpy()
        found: list[pd.DataFrame] = []
        for size in np.unique(rows["dimension"]):
            own = rows[rows["dimension"].to_numpy() == size]
            group, block = own["group"].to_numpy(), own["block"].to_numpy()
            one_block = (own["low"] == own["high"]).to_numpy()
            code = np.array([np.frombuffer(c, dtype=np.uint8) for c in own["code"]])
            ids, slot, factor = own["id"].to_numpy(), own["slot"].to_numpy(), own["factor"].to_numpy()
            t = tables.setdefault(int(size), Tables(int(size), bits, threshold))
            left, step = np.arange(len(own)), 1
            while True:
                left = left[left + step < len(own)]
                left = left[group[left] == group[left + step]]
                if not len(left):
                    break
                i, j = left, left + step
                fit = (one_block[i] | (block[i] != block[j])) & (ids[i] != ids[j])
                i, j = i[fit], j[fit]
                other = code[i] ^ code[j]
                near = np.bitwise_count(other).sum(axis=1, dtype=np.int64) <= t.most_different
                i, j, other = i[near], j[near], other[near]
                if len(i):
                    different = np.unpackbits(other, axis=1)[:, : t.width].astype(bool)
                    first = t.first_shared(different, slot[i])
                    i, j = i[first], j[first]
                    swap = ids[i] > ids[j]
                    a, b = np.where(swap, j, i), np.where(swap, i, j)
                    codes = own["code"].to_numpy()[b]
                    found.append(
                        pd.DataFrame({"a": ids[a], "b": ids[b], "dimension": np.int32(size), "code": codes, "factor": factor[b]})
                    )
                step += 1
        names = [x.split()[0] for x in PAIRED.split(", ")]
        return pd.concat(found) if found else pd.DataFrame({n: [] for n in names})

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables: dict[int, Tables] = {}
        held: list[pd.DataFrame] = []
        for batch in batches:
            new = (batch[["bucket", "low", "high"]].diff() != 0).any(axis=1).to_numpy()
            ends = np.flatnonzero(new[1:])
            if not len(ends):
                held.append(batch)
                continue
            cut = int(ends[-1]) + 1
            yield from done([*held, batch.iloc[:cut]], tables)
            held = [batch.iloc[cut:]]
        if held:
            yield from done(held, tables)

    def done(parts: list[pd.DataFrame], tables: dict[int, Tables]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(parts, ignore_index=True)
        rows["group"] = (rows[["bucket", "low", "high"]].diff() != 0).any(axis=1).cumsum()
        found = of(rows, tables)
        if len(found):
            yield found.astype({"a": "int64", "b": "int64", "dimension": "int32"})

    return rows


def _estimated(threshold: float):
    """Keep the pairs whose upper confidence bound reaches the threshold: an uncoded vector against the other's code."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn: dict[int, np.ndarray] = {}
        for batch in batches:
            keep = np.ones(len(batch), dtype=bool)
            for at, vectors in _by_dimension(batch["left"]):
                size = vectors.shape[1]
                matrix = turn.setdefault(size, rotations(size)[0])
                rotated = _unit(vectors) @ matrix.T
                codes = np.array([np.frombuffer(batch["code"].iloc[i], dtype=np.uint8) for i in at])
                signs = np.unpackbits(codes, axis=1)[:, :size] * 2.0 - 1.0
                factor = batch["factor"].to_numpy()[at]
                estimate = (rotated * signs).sum(axis=1) / math.sqrt(size) / factor
                bound = ERROR * np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(max(size - 1, 1))
                keep[at] = estimate + bound >= threshold
            yield batch.loc[keep, ["a", "b", "left"]]

    return rows


def _exact(threshold: float):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = np.zeros(len(batch), dtype=bool)
            for at, x in _by_dimension(batch["left"]):
                y = np.array([np.asarray(batch["right"].iloc[i], dtype=np.float64) for i in at])
                keep[at] = (_unit(x) * _unit(y)).sum(axis=1) >= threshold
            yield batch.loc[keep, ["a", "b"]]

    return rows


def near_vectors(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Per vector the number of others with a cosine of at least ``threshold`` and its component of such links.

    Takes ``vec_id, embedding``; other columns are ignored. Returns ``vec_id, n_links, component_id, kept``, one row per row.
    A vector that is NULL, empty, zero, or has NULL or non-finite components is linked with nothing, and vectors of different
    length are not linked. Equal vectors under different rows all count as links. A vector id is one node: rows that share
    it share a component. Rows without an id are linked with nothing. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    base = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("vector")
    )
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(F.col("vec_id").isNotNull() & ~bad & F.exists("vector", lambda x: x != 0), F.lit(False))
    base = base.withColumn("usable", usable)
    hashed = base.withColumn("h1", F.xxhash64("vector")).withColumn("h2", F.xxhash64("vector", F.lit(1)))
    keys = ["h1", "h2"]
    good = hashed.where("usable")
    classes = good.groupBy(*keys).agg(F.min("vec_id").alias("id"), F.count("*").alias("size"))
    classes = cut_lineage(classes)
    # A class's vector: any row of it, as they are equal.
    held = good.join(classes, keys).where(F.col("vec_id") == F.col("id")).select("id", *keys, "vector")
    held = cut_lineage(held.dropDuplicates(["id", *keys]).select("id", "vector"))

    bits = max(4, math.ceil(math.log2(max(held.count(), 2) / BUCKET)))
    coded = held.mapInPandas(_coded(bits, threshold), CODED)
    sizes = coded.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    dealt = coded.join(sizes, "bucket", "left").withColumn("blocks", F.ceil(F.coalesce("n", F.lit(1)) / BLOCK).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(F.least(F.col("block"), j).alias("low"), F.greatest(F.col("block"), j).alias("high")),
    )
    dealt = dealt.withColumn("meet", F.explode(meets)).select(
        "bucket", "meet.low", "meet.high", "block", "slot", "id", "dimension", "code", "factor"
    )
    dealt = dealt.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    pairs = dealt.mapInPandas(_pairs(bits, threshold), PAIRED)

    left = pairs.join(held.select(F.col("id").alias("a"), F.col("vector").alias("left")), "a")
    likely = left.mapInPandas(_estimated(threshold), "a long, b long, left array<double>")
    both = likely.join(held.select(F.col("id").alias("b"), F.col("vector").alias("right")), "b")
    links = cut_lineage(both.mapInPandas(_exact(threshold), "a long, b long").distinct())

    found = components(links)
    ways = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weights = classes.groupBy(F.col("id").alias("b")).agg(F.sum("size").alias("size"))
    outside = ways.join(weights, "b").groupBy(F.col("a").alias("id")).agg(F.sum("size").alias("outside"))
    named = classes.join(outside, "id", "left").join(found.withColumnRenamed("node", "id"), "id", "left")
    named = named.select(
        *keys,
        (F.col("size") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    placed = hashed.select("vec_id", "usable", *keys).join(named, keys, "left")
    linked = F.col("usable") & F.col("component_id").isNotNull()
    component = F.when(linked, F.col("component_id")).otherwise(F.col("vec_id"))
    return placed.select(
        "vec_id",
        F.when(linked, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
