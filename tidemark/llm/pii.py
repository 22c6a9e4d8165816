"""Personal data: fixed patterns, and weak supervision that judges looser candidates.

Candidates are the spans of the fixed patterns and of looser forms (numbers with separators, spelt-out e-mail addresses,
account and social security numbers). Labelling functions of three sorts vote on each: the shape of the text, small
gazetteers, and the words around it. The votes of all candidates are counted by pattern in Spark; expectation-maximisation
on those counts, whose number is fixed, estimates how reliable each function is. Its posteriors train a logistic span
classifier on the same counts, joined with span features of fixed number. The classifier then decides in a second pass which
looser candidates are added. Base spans always stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import sha256_hex, small_batches, span_text, text_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "ssn", "iban")

# The base patterns. The look-behind and the possessive number keep long runs of digits linear; they find
# the same matches, as a match that fails at the start of such a run fails inside it too.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}", re.ASCII)
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+", re.ASCII)
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]", re.ASCII)
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", re.ASCII)
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Looser forms.
SPELT = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[(\[]\x20?at\x20?[)\]]\x20?[A-Za-z0-9-]{1,63}"
    r"(?:(?:\.|\x20?[(\[]\x20?dot\x20?[)\]]\x20?)[A-Za-z0-9-]{1,63})+",
    re.ASCII,
)
NATIONAL = re.compile(r"(?<![0-9A-Za-z+.])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{4}(?![0-9A-Za-z])", re.ASCII)
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", re.ASCII)
IBAN = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])", re.ASCII)

# Gazetteers: words that stand near personal data, or near numbers that are none.
NEAR = {
    "email": {"email", "mail", "e-mail", "contact", "write", "correo", "courriel"},
    "ip": {"ip", "host", "address", "server", "login", "from"},
    "card": {"card", "visa", "mastercard", "credit", "carte", "karte", "tarjeta", "pay"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "cell", "fax", "telefon", "teléfono", "téléphone", "whatsapp"},
    "ssn": {"ssn", "social", "security"},
    "iban": {"iban", "account", "bank", "konto", "cuenta", "compte"},
}
AGAINST = {"version", "v", "isbn", "page", "pages", "order", "id", "no", "nr", "license", "licence", "article", "section", "rfc"}
TOP_DOMAINS = {"com", "org", "net", "edu", "gov", "de", "fr", "es", "io", "uk", "eu", "info"}
CONTEXT_CHARS = 48
WORD = re.compile(r"[^\W_]+(?:-[^\W_]+)?")

VOTERS = ("shape", "check", "gazetteer", "context", "against")
SIGNATURE = "kind int, base boolean, shape int, check int, gazetteer int, context int, against int, length int, groups int"
FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def email_spans(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping addresses, each found from its @ so that long runs without one cost nothing."""
    spans, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            spans.append((start, match.end()))
            done = match.end()
        else:
            done = at + 1  # no local part reaches over an @
        at = text.find("@", done)
    return spans


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns by kind as listed, then start."""
    spans = [("email", s, e) for s, e in email_spans(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p) < 30 and int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return spans


def _free(spans: list[tuple[str, int, int]], start: int, end: int) -> bool:
    return not any(s < end and start < e for _, s, e in spans)


def loose_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Looser candidates that overlap neither a base span nor each other; the earlier form in the list wins."""
    every = list(base)
    forms = [("ssn", SSN), ("iban", IBAN), ("phone", NATIONAL)]
    if "at" in text and ("(" in text or "[" in text):
        forms.insert(0, ("email", SPELT))
    for kind, pattern in forms:
        for m in pattern.finditer(text):
            if _free(every, *m.span()):
                every.append((kind, *m.span()))
    return every[len(base) :]


def signature(text: str, kind: str, start: int, end: int, base: bool) -> tuple[int, ...]:
    """The votes (1 for, 0 against, -1 no vote) and features of a candidate."""
    span = text[start:end]
    digits = _digits(span)
    words = [w.lower() for w in WORD.findall(text[max(0, start - CONTEXT_CHARS) : start])[-4:]]
    shape = 1 if base else 0 if span.count(".") and kind == "phone" else -1
    check = -1
    if kind == "card":
        check = int(luhn(digits))
    elif kind == "iban":
        check = int(_iban_ok(span))
    elif kind == "ssn":
        check = int(digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000")
    gazetteer = -1
    if kind == "email":
        gazetteer = int(span.lower().rsplit(".", 1)[-1].strip(" )]") in TOP_DOMAINS)
    elif kind == "phone":
        gazetteer = int(digits[:3] not in ("000", "999")) if len(digits) >= 10 else -1
    context = 1 if any(w in NEAR[kind] for w in words) else -1
    against = 0 if any(w in AGAINST for w in words[-2:]) else -1
    groups = len([g for g in re.split(r"[^0-9A-Za-z]+", span) if g])
    return KINDS.index(kind), base, shape, check, gazetteer, context, against, min(len(digits), 20), min(groups, 8)


def _iban_ok(span: str) -> bool:
    text = span.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: dict[tuple[int, ...], int] = {}
    for batch in batches:
        for text in batch["text"]:
            base = base_spans(text)
            for spans, fixed in ((base, True), (loose_spans(text, base), False)):
                for kind, start, end in spans:
                    key = signature(text, kind, start, end, fixed)
                    counts[key] = counts.get(key, 0) + 1
    names = [x.split()[0] for x in SIGNATURE.split(", ")]
    yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=[*names, "n"])


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    reliability: dict[str, float]

    def accepts(self, key: tuple[int, ...]) -> bool:
        return float(features(np.array([key]))[0] @ self.weights) >= 0


def features(keys: np.ndarray) -> np.ndarray:
    """One row of numbers per signature: bias, kind, votes, digits and groups."""
    kinds = np.eye(len(KINDS))[keys[:, 0]]
    votes = keys[:, 2:7]
    return np.hstack([np.ones((len(keys), 1)), kinds, votes == 1, votes == 0, keys[:, 7:8] / 20, keys[:, 8:9] / 8]).astype(float)


def aggregate_votes(votes: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns with counts.

    Returns the chance that each pattern is personal data, and for each function how often it votes 1 on personal data and
    on anything else. A function that does not vote tells nothing.
    """
    share, right = 0.7, np.tile([[0.9, 0.1]], (votes.shape[1], 1))  # chance of a vote 1, given yes and given no
    weight = np.where(votes >= 0, 1.0, 0.0)
    chance = np.full(len(votes), share)
    for _ in range(rounds):
        logs = np.log(np.array([[share], [1 - share]])) + np.stack(
            [(weight * np.where(votes == 1, np.log(right[:, k]), np.log(1 - right[:, k]))).sum(axis=1) for k in (0, 1)]
        )
        chance = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -60, 60)))
        for k, c in ((0, chance), (1, 1 - chance)):
            seen = (weight * (n * c)[:, None]).sum(axis=0)
            ones = (weight * (votes == 1) * (n * c)[:, None]).sum(axis=0)
            prior = (4.5, 0.5) if k == 0 else (0.5, 4.5)
            right[:, k] = (ones + prior[0]) / (seen + 5)
        share = float(np.clip((n * chance).sum() / max(n.sum(), 1), 0.05, 0.95))
    return chance, right


def train(docs: DataFrame) -> Model:
    """Reliabilities and span classifier from the candidates of all texts; without candidates only base spans are found."""
    small_batches(docs.sparkSession)
    counted = docs.select(text_of().alias("text")).mapInPandas(_signatures, SIGNATURE + ", n long")
    names = [x.split()[0] for x in SIGNATURE.split(", ")]
    rows = counted.groupBy(*names).agg(F.sum("n").alias("n")).orderBy(*names).collect()  # signatures: a fixed number of kinds
    if not rows:
        return Model(np.full(features(np.zeros((1, 9), dtype=int)).shape[1], -1.0), {})
    keys = np.array([[int(v) for v in r[:-1]] for r in rows])
    n = np.array([r["n"] for r in rows], dtype=float)
    chance, right = aggregate_votes(keys[:, 2:7], n)
    chance = np.where(keys[:, 1] == 1, np.maximum(chance, 0.99), chance)  # a base span is personal data by definition
    x, weights = features(keys), np.zeros(features(keys).shape[1])
    scale = np.log1p(n)
    for _ in range(30):  # Newton steps for logistic regression with soft labels
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (scale * (chance - p)) - 0.1 * weights
        curve = (x * (scale * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(weights))
        weights = weights + np.linalg.solve(curve, slope)
    return Model(weights, dict(zip(VOTERS, (right[:, 0] - right[:, 1]).round(4).tolist(), strict=True)))


def find(text: str, model: Model) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The base spans, and all spans by kind as listed, then start."""
    base = base_spans(text)
    added = [s for s in loose_spans(text, base) if model.accepts(signature(text, *s, False))]
    return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1]))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the union, named after the first."""
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def find_pii(text: Column, model: Model) -> Column:
    """Personal data of a text: counts and digest of the base spans, and all spans.

    Only the text is read: other columns, ties and repeated rows make no difference. NULL counts as the empty text.
    """

    @F.pandas_udf(FOUND)
    def found(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            base, every = find("" if text is None else text, model)
            counts = [sum(k == kind for k, _, _ in base) for kind in BASE_KINDS]
            rows.append((*counts, sha256_hex(span_text(base)), span_text(every)))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in FOUND.split(", ")])

    return found(text)


def redacted(text: Column, model: Model) -> Column:
    """The text without its personal data; NULL stays NULL."""

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else redact(t, find(t, model)[1]) for t in texts], dtype=object)

    return cleaned(text)
