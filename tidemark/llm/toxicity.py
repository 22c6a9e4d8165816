"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding undoes disguises: case, accents, look-alike letters of other scripts, invisible characters, and digits or signs that
stand for letters. ``l`` and ``i`` fold together, as ``1`` and ``|`` may mean either. What is no letter then separates words.

The lexicon is learnt from a bounded labelled sample: beginnings of words and whole words that toxic documents have far more
often than others, weighted by their log-odds. Exception phrases (a term with the word before or after it) clear the terms inside
them; some are fixed, others are learnt where the phrase is harmless though its term is not. A document's sum of weights, as it is
and per word, goes into a logistic curve. It is fitted by cross-validation: each quarter of the sample is weighed by a lexicon
that was learnt from the other three.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, text_of
from tidemark.session import cut_lineage

PER_LABEL = 4000  # labelled rows of each label that are learnt from, at most
TERMS, PHRASES = 5000, 1000  # of the lexicon, at most
SHORTEST, LONGEST = 3, 8  # letters of a word's beginning
LEAST_DOCS, LEAST_SHARE = 3, 0.01  # toxic documents that a term is in, as a number and of all toxic ones
LEAST_WEIGHT, LEAST_EVIDENCE = 2.5, 20.0  # log-odds of a term, and its likelihood-ratio statistic
PARTS = 4  # of the sample, for cross-validation
TOXIC_FROM = 0.3

# Letters of other scripts that look like Latin ones, and signs used for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѵ": "v", "ԝ": "w", "г": "r",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "|": "i", "€": "e"}
EXCEPTIONS = (
    "clown fish", "class clown", "trash can", "trash bin", "trash bag", "trash collection", "take out the trash", "idiot proof",
    "pond scum", "soap scum", "loser bracket", "stupid question", "worthless check", "pathetic fallacy",
)
# End of fixed values.


class _Fold(dict):
    """Code point to folded text, worked out when first met."""

    def __missing__(self, point: int) -> str:
        out = []
        for ch in unicodedata.normalize("NFKD", chr(point)).lower():
            kind = unicodedata.category(ch)
            if ch in SUBSTITUTES or ch in LOOKALIKES:
                out.append(SUBSTITUTES.get(ch) or LOOKALIKES[ch])
            elif kind[0] == "L":
                out.append(ch)
            elif kind not in ("Mn", "Me", "Cf"):  # marks and invisible characters vanish
                out.append(" ")
        folded = self[point] = "".join(out).replace("l", "i")
        return folded


_FOLD = _Fold()


def fold(text: str) -> str:
    """The folded words of a text, separated, begun and ended by one space."""
    return f" {' '.join(text.translate(_FOLD).split())} "


def _terms(folded: str) -> set[str]:
    """What may become a term: a space and the beginning of a word, or a whole word between spaces."""
    out = set()
    for word in set(folded.split()):
        if len(word) >= SHORTEST:
            out.update(f" {word[:n]}" for n in range(SHORTEST, min(len(word), LONGEST) + 1))
            out.add(f" {word} ")
    return out


@dataclass
class Lexicon:
    """Terms with weights, exception phrases, and the logistic curve; of bounded size, see TERMS and PHRASES."""

    terms: dict[str, float]
    phrases: frozenset[str] = frozenset()
    curve: tuple[float, float, float] | None = None
    _automaton: object = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return self.terms, self.phrases, self.curve

    def __setstate__(self, state):
        self.terms, self.phrases, self.curve = state
        self._automaton = None

    def automaton(self):
        if self._automaton is None:
            built = ahocorasick.Automaton()
            for key in {*self.terms, *self.phrases}:
                built.add_word(key, (len(key), self.terms.get(key, 0.0), key in self.phrases))
            built.make_automaton()
            self._automaton = built
        return self._automaton

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """Start, length and weight of the longest term at each start that lies in no exception phrase, in order."""
        if not self.terms:
            return []
        best: dict[int, tuple[int, float]] = {}
        cleared: list[tuple[int, int]] = []
        for end, (length, weight, excepted) in self.automaton().iter(folded):
            start = end + 1 - length
            if excepted:
                cleared.append((start, end))
            elif length > best.get(start, (0, 0.0))[0]:
                best[start] = length, weight
        if cleared:
            best = {s: v for s, v in best.items() if not any(a <= s < b for a, b in cleared)}
        return [(s, *best[s]) for s in sorted(best)]

    def weigh(self, text: str) -> tuple[float, int]:
        """Sum of the weights of a text's terms, and its number of words."""
        folded = fold(text)
        return sum(w for _, _, w in self.hits(folded)), folded.count(" ") - 1

    def score(self, text: str) -> float:
        if self.curve is None:
            return 0.0
        a, b, c = self.curve
        x = _features(*self.weigh(text))
        return float(1 / (1 + np.exp(-np.clip(a + b * x[0] + c * x[1], -60, 60))))


def _features(weight: float, words: int) -> tuple[float, float]:
    return float(np.log1p(weight)), float(np.log1p(100 * weight / max(words, 1)))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def labelled_texts(docs: DataFrame, labels: DataFrame, per_label: int) -> DataFrame:
    """``text, label, part``: what is learnt from. ``per_label`` documents of each label, those whose ids have the smallest hashes.

    Held-out ids, NULL ids and NULL labels are left out; an id labelled more than once counts by majority, ties as toxic. Of
    documents with one id the smallest text counts. ``part`` is the quarter of the sample, from 0 on.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("double").alias("toxic"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    one = known.groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("label"))
    order = [F.xxhash64("doc_id", F.lit(23)), "doc_id"]
    sides = [one.where(F.col("label") == k).orderBy(*order).limit(per_label) for k in (0, 1)]
    sample = F.broadcast(sides[0].unionByName(sides[1]))  # 2 * per_label rows at most
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(sample, "doc_id")
    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return texts.select("text", "label", F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(PARTS)).alias("part"))


def _first_of_copies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``sign``: the smallest hash of three folded words in a row, which near copies share most of the time."""
    for batch in batches:
        signs = []
        for text in batch["text"]:
            words = fold(text).split()
            rows = zip(words, words[1:], words[2:], strict=False) if len(words) > 2 else [tuple(words)]
            signs.append(min(pd.util.hash_array(np.array([" ".join(r) for r in rows], dtype=object)).view(np.int64).tolist()))
        yield batch.assign(sign=signs)


def _counted(found):
    """Documents per label and part that ``found`` finds a text in, merged within a batch."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (label, part), some in batch.groupby(["label", "part"]):
                counts = Counter(x for text in some["text"] for x in found(fold(text)))
                if counts:
                    yield pd.DataFrame({"found": list(counts), "label": label, "part": part, "n": list(counts.values())})

    return rows


def _contexts(folded: str, hits: Iterable[tuple[int, int, float]]) -> set[str]:
    """Each hit's word with the word before it and with the word after it."""
    out = set()
    for start, _, _ in hits:
        end = folded.index(" ", start + 1)
        before, after = folded.rfind(" ", 0, start), folded.find(" ", end + 1)
        if before >= 0:
            out.add(folded[before : end + 1])
        if after >= 0:
            out.add(folded[start : after + 1])
    return out


def _evidence(n1: np.ndarray, n0: np.ndarray, all1: int, all0: int) -> np.ndarray:
    """Likelihood-ratio statistic of a term against documents of both labels having it alike."""
    share = all1 / (all1 + all0)
    n = np.maximum(n1 + n0, 1)
    parts = [np.where(k > 0, k * np.log(np.maximum(k, 1) / (n * s)), 0.0) for k, s in ((n1, share), (n0, 1 - share))]
    return 2 * (parts[0] + parts[1])


def _chosen(names: list[str], counts: np.ndarray, totals: np.ndarray, parts: list[int]) -> dict[str, float]:
    """Weights of the terms that the documents of ``parts`` make known; ``counts`` by term, label and part.

    The strongest come first, of equal ones the longest beginning of a word. A term that begins with a kept one adds nothing; one
    that a kept one begins with has to be a sign of toxicity without that one's documents.
    """
    all0, all1 = (int(totals[k, parts].sum()) for k in (0, 1))
    if not all0 or not all1 or not names:
        return {}
    n0, n1 = (counts[:, k][:, parts].sum(axis=1) for k in (0, 1))

    def told(n1, n0):
        weight = np.log((n1 + 0.5) / (all1 + 1)) - np.log((n0 + 0.5) / (all0 + 1))
        good = (n1 >= max(LEAST_DOCS, LEAST_SHARE * all1)) & (weight >= LEAST_WEIGHT)
        return weight, good & (_evidence(n1, n0, all1, all0) >= LEAST_EVIDENCE)

    weight, good = told(n1, n0)
    order = sorted(np.flatnonzero(good), key=lambda i: (-weight[i], names[i].endswith(" "), -len(names[i]), names[i]))
    kept: dict[str, float] = {}
    covered: dict[str, np.ndarray] = {}  # documents of the kept terms that begin with a text
    for i in order:
        term = names[i]
        if len(kept) == TERMS:
            break
        if any(term[:n] in kept for n in range(SHORTEST + 1, len(term))):
            continue
        rest = np.maximum(np.array([n1[i], n0[i]]) - covered.get(term, 0), 0)
        if term in covered and not told(rest[:1], rest[1:])[1][0]:
            continue
        kept[term] = float(weight[i])
        for n in range(SHORTEST + 1, len(term)):
            covered[term[:n]] = covered.get(term[:n], np.zeros(2)) + (n1[i], n0[i])
    return kept


def _fitted(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton's method with a small penalty on the slopes."""
    z = np.column_stack((np.ones(len(x)), x))
    beta, penalty = np.zeros(3), np.diag([1e-6, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        slope = z.T @ (y - p) - penalty @ beta
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty + 1e-9 * np.eye(3), slope)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(b) for b in beta)


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Lexicon:
    """Lexicon, exceptions and curve from at most ``2 * per_label`` labelled documents, of near copies one.

    Without documents of both labels every score is 0. What reaches the driver is a lexicon of at most TERMS terms and PHRASES
    phrases, the counts they are chosen by, and two numbers for each document of the sample.
    """
    small_batches(docs.sparkSession)
    texts = labelled_texts(docs, labels, per_label)
    signed = texts.mapInPandas(_first_of_copies, "text string, label int, part long, sign long")
    sample = signed.groupBy("label", "sign").agg(F.min_by(F.struct("text", "part"), F.xxhash64("text")).alias("one"))
    sample = cut_lineage(sample.select("label", "one.text", "one.part"))
    totals = np.zeros((2, PARTS))
    for r in sample.groupBy("label", "part").agg(F.count("*").alias("n")).collect():
        totals[r["label"], r["part"]] = r["n"]
    all0, all1 = totals.sum(axis=1)
    fixed = frozenset(fold(p) for p in EXCEPTIONS)
    if not all1 or not all0:
        return Lexicon({}, fixed)

    def counted(found) -> DataFrame:
        rows = sample.mapInPandas(_counted(found), "found string, label int, part long, n long")
        sums = [
            F.sum(F.when((F.col("label") == k) & (F.col("part") == p), F.col("n")).otherwise(0)).alias(f"n{k}{p}")
            for k in (0, 1)
            for p in range(PARTS)
        ]
        n0, n1 = (sum(F.col(f"n{k}{p}") for p in range(PARTS)) for k in (0, 1))
        return rows.groupBy("found").agg(*sums).withColumns({"n0": n0, "n1": n1})

    # Wider than the choice, as the choice is also made for three parts alone.
    odds = F.log((F.col("n1") + 0.5) / F.lit(all1 + 1)) - F.log((F.col("n0") + 0.5) / F.lit(all0 + 1))
    likely = counted(_terms).where((F.col("n1") >= max(LEAST_DOCS, LEAST_SHARE * all1 * 0.75)) & (odds >= LEAST_WEIGHT - 0.5))
    rows = likely.orderBy(F.desc("n1"), "found").limit(20 * TERMS).collect()
    names = [r["found"] for r in rows]
    counts = np.array([[[r[f"n{k}{p}"] for p in range(PARTS)] for k in (0, 1)] for r in rows], dtype=float).reshape(-1, 2, PARTS)
    terms = _chosen(names, counts, totals, list(range(PARTS)))
    plain = Lexicon(terms, fixed)
    seen = counted(lambda folded: _contexts(folded, plain.hits(folded)))
    harmless = seen.where((F.col("n0") >= LEAST_DOCS) & (F.col("n0") * all1 > F.col("n1") * all0))
    phrases = fixed | {r["found"] for r in harmless.orderBy(F.desc("n0"), "found").limit(PHRASES).collect()}

    others = [Lexicon(_chosen(names, counts, totals, [q for q in range(PARTS) if q != p]), phrases) for p in range(PARTS)]

    def weighed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = [_features(*others[p].weigh(t)) for p, t in zip(batch["part"], batch["text"], strict=True)]
            yield pd.DataFrame({"label": batch["label"], "x1": [x[0] for x in pairs], "x2": [x[1] for x in pairs]})

    points = sample.mapInPandas(weighed, "label int, x1 double, x2 double").collect()
    x = np.array([[r["x1"], r["x2"]] for r in points])
    y = np.array([r["label"] for r in points], dtype=float)
    order = np.lexsort((x[:, 1], x[:, 0], y))
    return Lexicon(terms, phrases, _fitted(x[order], y[order]))


def score(docs: DataFrame, text: Column, lexicon: Lexicon) -> Column:
    """The toxicity of a text, from 0 to 1.

    Only the whole text is read. NULL is the empty text, which scores as any text without a term does. Repeated rows score alike.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        known = shared.value
        return pd.Series([known.score(t or "") for t in texts], dtype="float64")

    return scored(text)
