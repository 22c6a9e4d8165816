"""Phrase collocations against a plain count."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import collocations
from tidemark.session import shared_dir


def brute(rows, least, percent=80, first=2000):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    out = []
    good = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    for (lang, words), a in good.items():
        cuts = [(2000000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        inside = any(
            other != words and longer_lang == lang and 100 * b >= percent * a and any(
                other[i : i + len(words)] == words for i in range(len(other) - len(words) + 1)
            )
            for (longer_lang, other), b in good.items() if len(other) > len(words)
        )
        if not inside:
            out.append((lang, " ".join(words), a, f[lang, words[:k]], f[lang, words[k:]], n[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:first]
        ranked += [(lang, i + 1, *r[1:]) for i, r in enumerate(own)]
    return sorted(ranked)


def told(df):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect())


WORDS = ["New", "york", "CITY", "is", "big", "Ü", "ü", "x y", "a-b", "42", "😀", "it's"]


def texts(seed, count=80):
    rnd = random.Random(seed)
    rows = []
    for _ in range(count):
        words = [rnd.choice(WORDS) if rnd.random() < 0.6 else "New york CITY" for _ in range(rnd.randrange(30))]
        seps = [rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "!\r\n", ";;", "\x0b"]) for _ in words]
        text = "".join(w + s for w, s in zip(words, seps))
        rows.append((rnd.choice(["en", "de", None, "und", ""]), rnd.choice([text, text, text, None, "", " ."])))
    return rows + rows[:10]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("least", [2, 6])
def test_against_a_plain_count(spark, seed, least):
    rows = texts(seed)
    df = spark.createDataFrame([(a, b, 1, "x", 5) for a, b in rows], "lang string, text string, n long, phrase string, item long")
    assert told(collocations.collocations(df.repartition(3), least=least)) == brute(rows, least)


def test_small_limits_and_long_documents(spark, monkeypatch):
    rnd = random.Random(5)
    words = [rnd.choice("abcdefgh") for _ in range(30_000)]
    rows = [("en", "".join(w + rnd.choice([" ", " ", ". "]) for w in words)), ("en", "z " * 5000), ("en", "q" * 3_000_000 + " q")]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert told(collocations.collocations(df, least=20, first=7)) == brute(rows, 20, first=7)


def test_rows_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "ROW_WORDS", 10)
    _, place, *_ = collocations.words(np.frombuffer(b"a b c. d e f g h. i j k l m n o p q r s t u v. w. x", np.uint8))
    cuts = collocations._cuts(place)
    assert cuts[0] == 0 and cuts[-1] == len(place) and all(place[c] - place[c - 1] == 2 for c in cuts[1:-1]) and len(cuts) > 2


def test_counts_leave_a_task_whole(monkeypatch):
    monkeypatch.setattr(collocations, "MERGE_ROWS", 50)
    counts, rng, got, want = collocations._Counts(), np.random.default_rng(0), Counter(), Counter()
    for _ in range(40):
        left, right = rng.integers(0, 12, 30), rng.integers(0, 12, 30)
        want.update(zip(left.tolist(), right.tolist()))
        for batch in [*counts.add(collocations.joined(left, right), left, right)]:
            for a, b, n in zip(*(batch.column(c).to_pylist() for c in ("left", "right", "n"))):
                got[a, b] += n
    for batch in counts.rest():
        for a, b, n in zip(*(batch.column(c).to_pylist() for c in ("left", "right", "n"))):
            got[a, b] += n
    assert got == want


def test_word_hashes_over_segments(monkeypatch):
    text = ("word other " * 50 + "x" * 300 + " tail word").encode()
    raw = np.frombuffer(text, np.uint8)
    whole = collocations.words(raw)[0]
    monkeypatch.setattr(collocations, "SEGMENT", 64)
    parts = collocations.words(raw)[0]
    assert (whole[:100] == parts[:100]).all() and whole[-1] == parts[-1] == whole[0] and len(set(parts.tolist())) == 4


def test_empty_table_and_no_files_left(spark):
    import os

    df = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(df).collect() == []
    left = os.listdir(shared_dir(spark).removeprefix("file://"))
    assert not [n for n in left if n.startswith("collocations")]
