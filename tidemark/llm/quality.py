"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A text becomes counts of hashed character-shape trigrams, letter bigrams and word repetitions; latent-semantic analysis
(a truncated singular value decomposition of the weighted counts) of a bounded labelled sample gives the space. The sample's
vectors are broadcast, every document's cosine with all of them is computed in blocks, and the labels of the nearest ones
vote, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import code_points, small_batches, text_of

PER_LABEL = 2000  # labelled rows of each label that are learnt from, at most
LATENT = 48
NEIGHBOURS = 48
SHARPNESS = 12  # power of the similarity in a vote
KEEP_FROM = 0.3

SHAPES, LETTERS, REPEATS = 1024, 256, 4
WIDTH = SHAPES + LETTERS + REPEATS

#: Shape of each of the first 128 code points: letters and digits by class, signs each their own; 1 for all others.
SHAPE = np.arange(130, dtype=np.uint64)
SHAPE[ord("a") : ord("z") + 1] = 1
SHAPE[ord("A") : ord("Z") + 1] = 2
SHAPE[ord("0") : ord("9") + 1] = 3
SHAPE[128] = 1  # letters beyond ASCII
SHAPE[129] = 2  # those that are upper case, roughly


def counts(text: str) -> np.ndarray:
    """The text's features, each block a distribution; all zero for a text without characters."""
    row = np.zeros(WIDTH, dtype=np.float32)
    points = code_points(text)
    if not len(points):
        return row
    wide = np.where((points >= 0xC0) & (points <= 0xDE), 129, 128)
    shape = SHAPE[np.where(points < 128, points, wide)]
    padded = np.concatenate(([10], shape, [10])).astype(np.uint64)
    mixed = padded[:-2] * np.uint64(0x9E3779B1) + padded[1:-1] * np.uint64(0x85EBCA77) + padded[2:] * np.uint64(0xC2B2AE3D)
    row[:SHAPES] = np.bincount((mixed >> np.uint64(11)) % np.uint64(SHAPES), minlength=SHAPES)
    low = (points | 32).astype(np.uint64)
    pairs = low[:-1] * np.uint64(0x9E3779B1) + low[1:] * np.uint64(0x85EBCA77)
    row[SHAPES : SHAPES + LETTERS] = np.bincount((pairs >> np.uint64(9)) % np.uint64(LETTERS), minlength=LETTERS)
    words = text.split()
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    lines = [x for x in text.split("\n") if x]
    row[-REPEATS:] = (again, len(words) - again, len(lines) - len(set(lines)), len(set(lines)))
    for block in (slice(0, SHAPES), slice(SHAPES, SHAPES + LETTERS), slice(WIDTH - 4, WIDTH - 2), slice(WIDTH - 2, WIDTH)):
        total = row[block].sum()
        if total:
            row[block] /= total
    return row


@dataclass(frozen=True)
class Model:
    """The space and the labelled vectors; of bounded size, see PER_LABEL, LATENT and WIDTH."""

    weights: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def latent(self, rows: np.ndarray) -> np.ndarray:
        x = (np.sqrt(rows) * self.weights) @ self.basis
        norms = np.linalg.norm(x, axis=1, keepdims=True)
        return np.divide(x, norms, out=np.zeros_like(x), where=norms > 0)

    def score(self, texts: list[str]) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(texts), self.prior)
        rows = np.array([counts(t) for t in texts]).reshape(len(texts), WIDTH)
        cosine = self.latent(rows) @ self.vectors.T  # one block: a batch of documents by all labelled vectors
        k = min(NEIGHBOURS, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(cosine, near, axis=1), 0, 1).astype(np.float64) ** SHARPNESS
        total = weight.sum(axis=1)
        votes = (weight * self.labels[near]).sum(axis=1)
        return np.where(total > 1e-12, votes / np.where(total > 1e-12, total, 1), self.prior)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def labelled_sample(labels: DataFrame, per_label: int) -> DataFrame:
    """Ids and labels to learn from: ``per_label`` of each label, those whose ids have the smallest hashes.

    Held-out ids, NULL ids and NULL labels are left out; an id labelled more than once counts by majority, ties as 1.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    one = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    order = [F.xxhash64("doc_id", F.lit(17)), "doc_id"]
    sides = [one.where(F.col("label") == k).orderBy(*order).limit(per_label) for k in (0, 1)]
    return sides[0].unionByName(sides[1])


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, seed: int = 5) -> Model:
    """The space and labelled vectors of a sample of at most ``2 * per_label`` documents.

    Of documents with one id the smallest text counts. Without labelled documents every score is 0.5.
    """
    small_batches(docs.sparkSession)
    sample = F.broadcast(labelled_sample(labels, per_label))  # 2 * per_label rows at most
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(sample, "doc_id")

    def shortened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [counts(t) for t in batch["text"]]
            at = [np.flatnonzero(r) for r in rows]
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "label": batch["label"], "at": at, "x": [r[i] for r, i in zip(rows, at, strict=True)]}
            )

    one = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = one.mapInPandas(shortened, "doc_id long, label int, at array<int>, x array<float>").orderBy("doc_id").collect()
    if not rows:
        empty = np.zeros((0, LATENT), dtype=np.float32)
        return Model(np.ones(WIDTH, np.float32), np.zeros((WIDTH, LATENT), np.float32), empty, np.zeros(0), 0.5)
    x = np.zeros((len(rows), WIDTH), dtype=np.float32)
    for i, row in enumerate(rows):
        x[i, row["at"]] = row["x"]
    y = np.array([r["label"] for r in rows], dtype=np.float64)
    weights = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 0.3
    z = np.sqrt(x) * weights
    start = np.random.default_rng(seed).standard_normal((len(z), LATENT + 8)).astype(np.float32)
    q = np.linalg.qr(z.T @ start)[0]
    for _ in range(6):  # subspace iteration for the leading right singular vectors
        q = np.linalg.qr(z.T @ (z @ q))[0]
    _, _, turn = np.linalg.svd(z @ q, full_matrices=False)
    basis = (q @ turn.T)[:, :LATENT].astype(np.float32)
    model = Model(weights, basis, np.zeros((0, LATENT), np.float32), y, float(y.mean()))
    return Model(weights, basis, model.latent(x).astype(np.float32), y, float(y.mean()))


def score(docs: DataFrame, text: Column, model: Model) -> Column:
    """The quality of a text, from 0 to 1, higher for better ones.

    Only the text is read. NULL is the empty text, which has no direction in the space and gets the sample's share of good
    labels. Ties between neighbours at the edge of the vote are broken by position in the sample; repeated rows score alike.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(["" if t is None else t for t in texts]))

    return scored(text)
