"""Secret scan: fixed patterns, and character Markov models that add random-looking tokens.

Two models of order one over the characters of tokens are compared by their log-likelihood ratio: one of random strings,
trained from the values that the fixed patterns find and from generated strings, and one of ordinary identifiers and words,
trained from all other tokens of the corpus and from the identifiers that its words make. Both are counts of character pairs, summed by Spark over all documents; what
reaches the driver has a fixed size.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import code_points, sha256_hex, small_batches, span_text, text_of, true_runs

# The base patterns.
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "random")
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."

SIZE = len(ALPHABET)
#: Symbol of each of the first 128 code points; SIZE stands for any other character.
SYMBOL = np.full(129, SIZE, dtype=np.int64)
SYMBOL[[ord(c) for c in ALPHABET]] = np.arange(SIZE)
HEX = np.zeros(129, dtype=bool)
HEX[[ord(c) for c in "0123456789abcdef"]] = True
TOKEN = SYMBOL < SIZE
TOKEN[ord(".")] = False

GENERATED = 2000  # random strings added to the labelled ones, so that no alphabet is missing
PAIR_SCHEMA = "random boolean, pair int, n long"
FOUND = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


@dataclass(frozen=True)
class Models:
    """Log-likelihood ratio of each pair of symbols, and the limits above which a token is a secret."""

    ratio: np.ndarray
    least_chars: int = 20
    least_mean: float = 1.2


def base_spans(text: str, points: np.ndarray | None = None) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns by start, then kind as listed."""
    points = _clipped(text) if points is None else points
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(int(s), 2, int(e)) for s, e in zip(*true_runs(HEX[points], 24), strict=True)]
    return [(KINDS[k], s, e) for s, k, e in sorted(spans)]


def _clipped(text: str) -> np.ndarray:
    return np.minimum(code_points(text), 128)


def _pairs(points: np.ndarray) -> np.ndarray:
    """Counts of neighbouring symbols, flattened; pairs with a character outside the alphabet do not count."""
    s = SYMBOL[points]
    both = (s[:-1] < SIZE) & (s[1:] < SIZE)
    return np.bincount(s[:-1][both] * SIZE + s[1:][both], minlength=SIZE * SIZE)


def _count_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    secret = np.zeros(SIZE * SIZE, dtype=np.int64)
    every = np.zeros(SIZE * SIZE, dtype=np.int64)
    for batch in batches:
        for text in batch["text"]:
            points = _clipped(text)
            every += _pairs(points)
            for kind, start, end in base_spans(text, points):
                value = start if kind != "assign" else end - len(ASSIGN.match(text, start)[1])
                secret += _pairs(points[value:end])
    for label, counts in ((True, secret), (False, np.maximum(every - secret, 0))):
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"random": label, "pair": at.astype(np.int32), "n": counts[at]})


def _identifiers(plain: np.ndarray) -> np.ndarray:
    """Pair counts of identifiers and paths made of the corpus's own words, in equal shares of the usual styles.

    Prose holds few names such as ``camelCase``, ``SNAKE_CASE`` or ``a/path.v2``. They follow from its words: the pairs within
    words keep their counts in any case, and words of the usual length meet with the letters that words end and begin with.
    """
    table = plain.reshape(SIZE, SIZE)
    low, up, digit, sign = slice(0, 26), slice(26, 52), slice(52, 62), slice(62, SIZE)
    inner = table[low, low] + 1.0
    joints = inner.sum() / 5  # a joint for every five pairs
    ends, starts = inner.sum(axis=0) / inner.sum(), inner.sum(axis=1) / inner.sum()
    out = np.zeros((SIZE, SIZE))
    out[low, low] += inner
    out[up, up] += inner / 4
    out[up, low] += joints * np.outer(starts, inner.sum(axis=0) / inner.sum())
    out[low, up] += joints * np.outer(ends, starts)
    signs, digits = np.full(SIZE - 62, 1 / (SIZE - 62)), np.full(10, 0.1)
    for letters in (low, up):
        out[letters, sign] += joints * np.outer(ends, signs)
        out[sign, letters] += joints * np.outer(signs, starts)
        out[letters, digit] += joints / 10 * np.outer(ends, digits)
    out[digit, digit] += joints / 2 * np.outer(digits, digits)
    out[digit, sign] += joints / 5 * np.outer(digits, signs)
    out[sign, digit] += joints / 5 * np.outer(signs, digits)
    return out.ravel()


def train(docs: DataFrame, generated: int = GENERATED, seed: int = 7) -> Models:
    """Both models from all texts. Without documents the models know the generated strings only and add nothing."""
    small_batches(docs.sparkSession)
    counts = docs.select(text_of().alias("text")).mapInPandas(_count_pairs, PAIR_SCHEMA)
    rows = counts.groupBy("random", "pair").agg(F.sum("n").alias("n")).collect()  # two models of SIZE * SIZE pairs at most
    secret, plain = np.zeros(SIZE * SIZE), np.zeros(SIZE * SIZE)
    for row in rows:
        (secret if row["random"] else plain)[row["pair"]] = row["n"]
    rng = random.Random(seed)
    for i in range(generated):
        letters = ALPHABET[:62] if i % 4 else ALPHABET[:64]
        made = "".join(rng.choice(letters) for _ in range(rng.randint(20, 44)))
        secret += _pairs(_clipped(made))

    def log_chance(counts: np.ndarray) -> np.ndarray:
        table = counts.reshape(SIZE, SIZE)
        symbol = (table.sum(axis=0) + 1) / (table.sum() + SIZE)
        weight = 5.0  # of the symbols' own shares, where a pair was hardly seen
        return np.log((table + weight * symbol) / (table.sum(axis=1, keepdims=True) + weight))

    ordinary = plain + _identifiers(plain)
    ratio = log_chance(secret) - log_chance(ordinary) if plain.any() else np.full((SIZE, SIZE), -1.0)
    return Models(ratio)


def added_spans(points: np.ndarray, base: list[tuple[str, int, int]], models: Models) -> list[tuple[str, int, int]]:
    """Tokens outside the base spans that the ratio finds random."""
    found = []
    for start, end in zip(*true_runs(TOKEN[points], models.least_chars), strict=True):
        start, end = int(start), int(end)
        if any(s < end and start < e for _, s, e in base):
            continue
        s = SYMBOL[points[start:end]]
        if models.ratio[s[:-1], s[1:]].mean() > models.least_mean:
            found.append(("random", start, end))
    return found


def scan(text: str, models: Models) -> tuple[int, int, int, str, str]:
    points = _clipped(text)
    base = base_spans(text, points)
    every = sorted(base + added_spans(points, base, models), key=lambda x: (x[1], KINDS.index(x[0])))
    counts = [sum(k == kind for k, _, _ in base) for kind in KINDS[:3]]
    return *counts, sha256_hex(span_text(base)), span_text(every)


def find_secrets(text: Column, models: Models) -> Column:
    """Secrets of a text: counts and digest of the base spans, and all spans.

    Only the text is read: other columns, ties and repeated rows make no difference. NULL counts as the empty text, which
    has no spans. Time and memory are linear in the text's length.
    """

    @F.pandas_udf(FOUND)
    def found(texts: pd.Series) -> pd.DataFrame:
        rows = [scan("" if t is None else t, models) for t in texts]
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return found(text)
