"""Secrets, personal data and quality: against naive versions, and on awkward rows."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import pii, quality, secret_scan
from tidemark.llm.common import sha256_hex

AWKWARD = [None, "", " ", "\n\n", "x" * 200_000, "9" * 100_000, "a." * 50_000, "+" * 1000, "@" * 1000, "é字🙂" * 10, "dup", "dup"]


def naive_secrets(text):
    found = []
    word = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in "password passwd secret token api_?key".split())
    for m in re.finditer(rf"""(?:{word})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 6:
            found.append((m.start(), 0, m.end(), "assign"))
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, s, e) for s, _, e, k in sorted(found)]


def naive_pii(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if max(map(int, m[0].split("."))) < 256]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 16 <= len(d) <= 19 and sum(d[::2]) % 10 == -sum(sum(divmod(2 * c, 10)) for c in d[1::2]) % 10:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


@pytest.mark.parametrize("seed", range(20))
def test_base_spans_equal_naive_patterns(seed):
    rng = random.Random(seed)
    bits = ["password", "Token", "API_key", "ſecret", '"', "'", " ", ":", "=", "AKIA", "A1", "deadbeef", "0123", "x@y", "@", ".com", "é"]
    bits += ["+1", "(", ")", "-", ".", "4111 1111 1111 1111", "4111-1111", "255.", "1.2.3.4", "256.1.1.1", "\n", "a.b@c.d", "%"]
    for _ in range(300):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))
        assert secret_scan.base_spans(text) == naive_secrets(text)
        assert pii.base_spans(text) == naive_pii(text)


def test_secrets_on_awkward_rows(spark, docs):
    frame = docs(*AWKWARD)
    models = secret_scan.train(frame)
    rows = frame.select("doc_id", "spans", secret_scan.find_secrets(F.col("text"), models).alias("f")).collect()
    assert len(rows) == len(AWKWARD)
    assert rows[0]["f"]["base_sha256"] == rows[1]["f"]["base_sha256"] == sha256_hex("")
    assert [r["f"]["spans"] for r in rows] == ["hex:0:100000" if t == "9" * 100_000 else "" for t in AWKWARD]
    assert docs().select(secret_scan.find_secrets(F.col("text"), secret_scan.train(docs()))).collect() == []


def test_random_tokens_are_added_and_names_are_not(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    models = secret_scan.train(docs)
    rng = random.Random(3)
    letters = secret_scan.ALPHABET[:62]
    tokens = ["".join(rng.choice(letters) for _ in range(32)) for _ in range(200)]
    hits = sum(secret_scan.scan(f"use {t} now", models)[-1] == "random:4:36" for t in tokens)
    assert hits >= 195
    names = ["getUserAccountSettings", "the_total_number_of_rows", "onthentherationstheand", "well-known-and-much-used", "INTERNATIONALISATION"]
    assert [secret_scan.scan(n, models)[-1] for n in names] == [""] * len(names)
    kept = secret_scan.scan("password=abcdef12345 and deadbeef" + "0" * 16, models)
    assert kept[:3] == (1, 0, 1)


def test_pii_on_awkward_rows(spark, docs):
    frame = docs(*AWKWARD)
    model = pii.train(frame)
    rows = frame.select(pii.find_pii(F.col("text"), model).alias("f"), pii.redacted(F.col("text"), model).alias("t")).collect()
    assert len(rows) == len(AWKWARD) and rows[0]["t"] is None
    assert rows[0]["f"]["base_sha256"] == rows[1]["f"]["base_sha256"] == sha256_hex("")
    assert [r["t"] for r in rows[1:]] == AWKWARD[1:]
    assert docs().select(pii.find_pii(F.col("text"), pii.train(docs()))).collect() == []


def test_votes_find_reliable_functions():
    import numpy as np

    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.6
    right = [0.95, 0.9, 0.6]
    votes = np.stack([np.where(rng.random(len(truth)) < r, truth, ~truth) for r in right], axis=1).astype(int)
    patterns, at, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    chance, rates = pii.aggregate_votes(patterns, n.astype(float))
    assert ((chance[at.ravel()] > 0.5) == truth).mean() > 0.94
    assert list(np.argsort(rates[:, 0] - rates[:, 1])) == [2, 1, 0]


def test_loose_forms_are_judged_and_base_spans_stay(spark, docs):
    lines = [f"call me: phone +1 (555) 010-{i:04d} or mail a{i}@b.com" for i in range(50)]
    lines += [f"my ssn 123-45-{6000 + i} here, phone (212) 555-{i:04d}" for i in range(20)] + ["version 123-45-6789 of page 12"]
    model = pii.train(docs(*lines))
    base, every = pii.find("phone (212) 555-0199, card 4111 1111 1111 1111, a@b.com", model)
    assert [k for k, _, _ in base] == ["email", "card"] and set(base) <= set(every)
    assert [k for k, _, _ in every] == ["email", "card", "phone"]
    assert pii.redact("mail a@b.com!", [("email", 5, 12)]) == "mail [EMAIL]!"
    assert pii.redact("abcdef", [("ip", 0, 4), ("card", 2, 6)]) == "[IP]"


def test_quality_is_learnt(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    scored = docs.select("doc_id", quality.held_out(F.col("doc_id")).alias("out"), quality.score(docs, F.col("text"), model).alias("score"))
    rows = scored.where("out").join(labels, "doc_id").select("score", "quality").collect()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    assert sum(s >= quality.KEEP_FROM for s in good) >= 0.98 * len(good)
    assert sum(s < quality.KEEP_FROM for s in bad) >= 0.85 * len(bad)


def test_quality_learns_from_no_held_out_label(spark):
    labels = spark.range(2000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    sample = quality.labelled_sample(labels, 300)
    assert sample.count() == 600
    assert sample.where(quality.held_out(F.col("doc_id"))).count() == 0


def test_quality_on_awkward_rows(spark, docs):
    frame = docs(*AWKWARD)
    labels = spark.createDataFrame([(4, 1), (9, 0), (11, 0), (None, 1), (1, None), (4, 1), (4, 0)], "doc_id long, quality int")
    model = quality.train(frame, labels)
    scores = [r[0] for r in frame.select(quality.score(frame, F.col("text"), model)).collect()]
    assert len(scores) == len(AWKWARD) and all(0 <= s <= 1 for s in scores)
    assert scores[0] == scores[1] and scores[10] == scores[11]
    none = quality.train(docs(), labels)
    assert [r[0] for r in frame.select(quality.score(frame, F.col("text"), none)).collect()] == [0.5] * len(AWKWARD)
