"""Toxicity: folding, matching, exceptions, learning, held-out accuracy."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity
from tidemark.llm.queries import QUERIES


def test_folding_undoes_disguises():
    plain = toxicity.fold("idiot")
    for text in ("IDIOT", "1d10t", "іdіоt", "id​iot", "ïdîöt", "ｉｄｉｏｔ", "!idiot?", "|d|0t", "ídiot"):
        assert toxicity.fold(text) == plain
    assert toxicity.fold("") == "  " and toxicity.fold("a,b") == " a b "


def brute(lexicon, folded):
    """The longest term at each start that is in no phrase (whose last space may begin the next word)."""
    spans = [(s, s + len(p) - 1) for p in lexicon.phrases for s in range(len(folded)) if folded.startswith(p, s)]
    out = []
    for s in range(len(folded)):
        fit = [t for t in lexicon.terms if folded.startswith(t, s)]
        if fit and not any(a <= s < b for a, b in spans):
            best = max(fit, key=len)
            out.append((s, len(best), lexicon.terms[best]))
    return out


def test_matching_against_brute_force():
    rnd = random.Random(1)
    words = ["idiot", "idea", "trash", "can", "scum", "pond", "a"]
    terms = {" id": 1.0, " idiot": 3.0, " trash": 2.0, " scum ": 2.5}
    phrases = frozenset(toxicity.fold(p) for p in ("trash can", "pond scum"))
    lexicon = toxicity.Lexicon({t.replace("l", "i"): w for t, w in terms.items()}, phrases)
    for _ in range(300):
        folded = toxicity.fold(" ".join(rnd.choice(words) for _ in range(rnd.randrange(8))))
        assert lexicon.hits(folded) == brute(lexicon, folded)
    assert lexicon.weigh("pond scum in a trash can")[0] == 0 and lexicon.weigh("scum, trash")[0] == 4.5


def sample(spark, n=400):
    rnd = random.Random(2)
    rows, marks = [], []
    for i in range(n):
        words = [f"w{rnd.randrange(300)}x" for _ in range(rnd.randrange(5, 60))]
        toxic = int(i % 4 == 0)
        if toxic:
            words.insert(rnd.randrange(len(words)), rnd.choice(["grobian", "grobianly", "foulzap"]))
        elif i % 4 == 1:
            words += ["nice", "foulzap", "pie"]
        rows.append((i, " ".join(words)))
        marks.append((i, 1, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_terms_and_exceptions_are_learnt(spark):
    docs, labels = sample(spark)
    lexicon = toxicity.train(docs, labels)
    assert any(t.startswith(" grobi") for t in lexicon.terms) and not any(" w" in t for t in lexicon.terms)
    assert lexicon.score("you GR0BIAN you") > 0.9 > 0.3 > lexicon.score("w1x w2x w3x w4x")
    assert lexicon.score("one grobian") > lexicon.score("one grobian " + "word " * 2000) > lexicon.score("")


def test_only_rows_that_may_be_learnt_from(spark):
    docs, labels = sample(spark, 120)
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, turned)
    assert (a.terms, a.phrases, a.curve) == (b.terms, b.phrases, b.curve)


def test_awkward_rows(spark, docs):
    labels = spark.createDataFrame([(0, 1, 1), (0, 1, 0), (None, 1, 1), (3, 1, None), (7, 0, 0)], "doc_id long, quality int, toxic int")
    frame = docs((0, None), (0, None), (None, "idiot"), (3, ""), (4, "x" * 2_000_000), (4, "idiot " * 50_000), (5, "😀 1d10t"))
    lexicon = toxicity.train(frame, labels)
    got = frame.select("doc_id", toxicity.score(frame, F.col("text"), lexicon).alias("score")).collect()
    assert len(got) == 7 and all(0 <= r["score"] <= 1 for r in got)
    empty = toxicity.train(frame.limit(0), labels.limit(0))
    assert empty.score("idiot") == 0.0 and frame.limit(0).select(toxicity.score(frame, F.col("text"), empty)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.1"])
def test_held_out_accuracy(spark, sf):
    path = f"/root/testdata/{sf}"
    labels = spark.read.parquet(f"{path}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op11_toxicity"](spark, path).where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    counts = {(r["toxic"], r["predicted"]): r["count"] for r in rows}
    caught, missed, wrong = counts.get((1, 1), 0), counts.get((1, 0), 0), counts.get((0, 1), 0)
    assert caught >= 0.9 * (caught + missed) and wrong <= 0.01 * counts[0, 0]
