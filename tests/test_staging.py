"""Staged copies, bulk extracts, lineage depth, stored exports."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions import value_key
from tidemark.operators import lineage, merge
from tidemark.operators.partitions import partition_filter
from tidemark.plans import outbound
from tidemark.plans.extracts import build_all_partitions, extract_path, read_extracts, write_partition
from tidemark.plans.refresh import refresh_table
from tidemark.plans.store import SnapshotStore, read_snapshot, versions
from tidemark.session import overridden, shared_dir, staging

NOW = "2025-01-02 00:00:00"


def left_behind(spark):
    return {n for n in os.listdir(shared_dir(spark).removeprefix("file://")) if n.startswith("stage-")}


def test_staged_copies_go(spark, tmp_path):
    before = left_behind(spark)
    with pytest.raises(ZeroDivisionError), staging(spark) as stage:
        assert stage(spark.range(5)).count() == 5 and left_behind(spark) > before
        raise ZeroDivisionError
    store, pick = SnapshotStore(str(tmp_path)), {"type": "filter", "select": ["id"]}
    for n in (3, 4):
        refresh_table(spark, pick, {"t": spark.range(n)}, store, NOW)
    lineage.refresh_order(chain(spark, 3), "m0").count()
    assert left_behind(spark) == before


def test_staged_copy_is_read_by_column(spark):
    with staging(spark) as stage:
        rows = stage(spark.range(5).withColumn("$_ref", F.lit("r")))
        plan = rows.select("`$_ref`").distinct()._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema: struct<$_ref:string>" in plan


def chain(spark, n):
    rows = [("m0", "base", [])] + [(f"m{i}", "derived", [f"m{i - 1}"]) for i in range(1, n + 1)]
    return spark.createDataFrame(rows, "id string, model_kind string, source_models array<string>")


def test_jobs_grow_with_the_logarithm_of_the_depth(spark):
    tracker = spark.sparkContext.statusTracker()
    jobs = {}
    with overridden(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        for n in (12, 40):
            spark.sparkContext.setJobGroup(f"chain-{n}", "")
            got = dict(map(tuple, lineage.refresh_order(chain(spark, n), "m0").collect()))
            assert got == {f"m{i}": i for i in range(1, n + 1)}
            jobs[n] = len(tracker.getJobIdsForGroup(f"chain-{n}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[40] <= 1.4 * jobs[12]


def test_cycles_are_errors(spark):
    loop = [("a", "base", []), ("b", "derived", ["a", "c"]), ("c", "derived", ["b"])]
    schema = "id string, model_kind string, source_models array<string>"
    with pytest.raises(ValueError, match="cycle"):
        lineage.refresh_order(spark.createDataFrame(loop, schema), "a")
    with pytest.raises(ValueError, match="cycle"):
        lineage.refresh_order(spark.createDataFrame([("a", "derived", ["b"]), ("b", "derived", ["a"])], schema), "a")
    assert lineage.refresh_order(spark.createDataFrame(loop, schema), "nothing").collect() == []


VALUES = ["007", "7", "", None, "7.50", "1" * 25, "ä/b c", "NULL", "null", "1e3", "-0", "x" * 300]


def test_bulk_extracts_keep_values(spark, tmp_path):
    one = spark.createDataFrame([(v, i) for i, v in enumerate(VALUES)], "v string, n int")
    two = spark.createDataFrame([(7, 1.5), (None, 2.5)], "v int, value double")
    counts = build_all_partitions({"one": one, "two": two, "none": None}, "v", str(tmp_path), "rule", {"one": "first one"})
    assert counts == {"first one": len(VALUES), "two": 2, "total_rows": len(VALUES) + 2}
    back = read_extracts(spark, str(tmp_path), "rule", "first one")
    assert sorted(map(tuple, back.collect()), key=lambda r: r[1]) == [(v, i) for i, v in enumerate(VALUES)]
    assert read_extracts(spark, str(tmp_path), "rule", "two").dtypes == two.dtypes
    for value in VALUES:
        path = extract_path(str(tmp_path), "rule", value, "first one")
        alike = [v for v in VALUES if v == value or (v and value and value_key(v) == value_key(value))]
        assert [r["v"] for r in spark.read.parquet(path).collect()] == alike
    write_partition({"first one": partition_filter(one, "v", "7")}, str(tmp_path), "rule", "7")
    assert read_extracts(spark, str(tmp_path), "rule", "first one").count() == len(VALUES)


@pytest.mark.parametrize(
    "value,found",
    [("7", ["007", "7"]), ("7.5", ["7.50"]), ("1" * 25, ["1" * 25]), ("0", ["-0"]), ("1000", ["1e3"]), ("-7", []), ("", [""]), ("1" * 24 + "2", [])],
)
def test_numeric_text_compares_by_digits(spark, value, found):
    rows = spark.createDataFrame([(v,) for v in VALUES], "v string")
    assert sorted(r["v"] for r in partition_filter(rows, "v", value).collect()) == found


def test_reconcile_from_one_match(spark):
    target = spark.createDataFrame([(1, "a", "x"), (1, "b", "x"), (2, "c", "x")], "k int, v string, w string")
    source = spark.createDataFrame([(1, "A"), (3, "C"), (3, "C")], "k int, v string")
    plain = merge.reconcile(target, source, ["k"])
    with staging(spark) as stage:
        staged = merge.reconcile(target, source, ["k"], stage=stage)
        for a, b in zip(plain, staged):
            assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    assert sorted(map(tuple, plain[0].collect()), key=str) == [(1, "A", "x"), (1, "A", "x"), (2, "c", "x"), (3, "C", None)]


def test_a_stored_export_runs_again_harmlessly(spark, tmp_path, monkeypatch):
    store, log = SnapshotStore(str(tmp_path / "t")), str(tmp_path / "log")
    plan = outbound.WritePlan("upsert", ("k",))
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    outbound.export_to_store(rows, store, plan, NOW, "one", changelog_path=log)
    with monkeypatch.context() as patch:
        patch.setattr(outbound, "mark_batch", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            outbound.export_to_store(rows.limit(1), store, plan, NOW, "two", changelog_path=log)
    assert [v.number for v in versions(spark, store)] == [1]
    for _ in range(2):
        result = outbound.export_to_store(rows.withColumn("v", F.lit("z")), store, plan, NOW, "two", changelog_path=log)
    assert (result.version, result.counts["rows"]) == (2, 2) and result.bytes > 0
    assert sorted(map(tuple, read_snapshot(spark, store).collect())) == [(1, "z"), (2, "z")]
    assert outbound.read_changelog(spark, log).count() == 4
