"""The pipeline: each stage against brute force on what it got."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import pii, quality
from llm.test_formats import checked
from llm.test_near import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    frames = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], SF).cache())
    return frames


def test_stages_keep_the_columns(steps):
    assert all(f.columns == steps[0].columns for f in steps[:-1])


def test_quality_rejects(spark, steps):
    model = quality.train(steps[0], spark.read.parquet(f"{SF}/labels.parquet"))
    want = {r["doc_id"] for r in steps[0].collect() if model.score([r["text"]])[0] >= quality.KEEP_FROM}
    assert {r["doc_id"] for r in steps[1].collect()} == want
    assert 0 < len(want) < steps[0].count()


def test_one_of_each_group_stays(steps):
    rows = sorted(map(tuple, steps[1].select("doc_id", "text").collect()))
    comps = brute([t for _, t in rows], 5)[1]
    assert {r["doc_id"] for r in steps[2].collect()} == {rows[i][0] for i, c in enumerate(comps) if i == c}


def test_personal_data_is_gone(steps):
    before = {r["doc_id"]: r["text"] for r in steps[2].collect()}
    after = {r["doc_id"]: r for r in steps[3].collect()}
    assert set(before) == set(after)
    assert all(pii.base_spans(r["text"]) == [] and r["n_chars"] == len(r["text"]) for r in after.values())
    assert any(pii.base_spans(t) for t in before.values())
    assert all(after[i]["text"] == t for i, t in before.items() if not pii.base_spans(t) and not pii.loose_spans(t, []))


def test_packed(steps):
    texts = {r["doc_id"]: r["text"] for r in steps[3].collect()}
    checked(steps[4].collect(), texts, 2048)


def test_run_is_the_stages_in_turn(spark, steps):
    got = corpus_pipeline.run(spark, SF).drop("ids").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, steps[4].drop("ids").collect()))


def test_stages_on_awkward_rows(spark, docs, tmp_path):
    spark.createDataFrame([(1, 1, 0), (2, None, None), (3, 0, 1), (3, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    frame = docs((1, "good text " * 9), (1, "good text " * 9), (None, None), (2, ""), (3, "### $$$"), (4, "x" * 50_000), (5, "a@b.com"))
    for rows in (frame, frame.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, str(tmp_path))
            rows.write.mode("overwrite").parquet(f"{tmp_path}/out-{_}")
            rows = spark.read.parquet(f"{tmp_path}/out-{_}")
        assert "sequence_id" in rows.columns
    assert rows.count() == 0
    one = corpus_pipeline.keep_first(spark, frame, "")
    assert sorted((r["doc_id"] or 0) for r in one.collect()) == [0, 1, 2, 3, 4, 5]
    assert one.columns == frame.columns
    assert frame.where(F.col("doc_id") == 1).count() == 2
