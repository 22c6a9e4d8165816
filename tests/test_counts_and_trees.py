"""Counted differences of rows without a key, and checksum trees."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cdc
from tidemark.plans import checksums
from tidemark.session import overridden

OLD, NOW = "2025-01-01 00:00:00", "2025-01-02 00:00:00"


def told(df):
    return Counter((r["v"], r["$_operation"], str(r["$_timestamp"]), str(r["$_last_updated"])) for r in df.collect())


def test_copies_are_counted(spark):
    before = cdc.first_refresh(spark.createDataFrame([(v,) for v in "aaabbcd"] + [(None,)], "v string"), OLD)
    now = spark.createDataFrame([(v,) for v in "abbbbce"] + [("",)], "v string")
    got = told(cdc.hash_cdc(now, before, NOW, counted=True))
    stays, new = (OLD, OLD), (NOW, NOW)
    assert got == Counter(
        {("a", "INSERT", *stays): 1, ("a", "DELETE", OLD, NOW): 2, ("b", "INSERT", *stays): 2, ("b", "INSERT", *new): 2}
        | {("c", "INSERT", *stays): 1, ("d", "DELETE", OLD, NOW): 1, ("e", "INSERT", *new): 1, ("", "INSERT", *stays): 1}
    )
    assert told(cdc.hash_cdc(now.limit(0), before, NOW, counted=True)).total() == 8
    empty = cdc.first_refresh(now.limit(0), OLD)
    assert told(cdc.hash_cdc(now, empty, NOW, counted=True)) == Counter({k: n for k, n in told(cdc.first_refresh(now, NOW)).items()})


def test_a_hot_row_is_numbered_in_parts(spark):
    rows = spark.range(40_000, numPartitions=4).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("v"))
    before = cdc.first_refresh(rows, OLD)
    more = rows.unionAll(rows.where("v = -1").limit(100))
    with overridden(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        got = cdc.hash_cdc(more, before, NOW, counted=True)
        assert got.groupBy("`$_timestamp`").count().orderBy("count").collect()[0]["count"] == 100
        assert got.where("`$_operation` = 'DELETE'").isEmpty()
        sizes = cdc._numbered(cdc.ensure_row_hash(rows)).where("v = -1").agg(F.count_distinct("__number"), F.max("__number")).first()
    assert tuple(sizes) == (26_666, 26_666)


@pytest.fixture
def trees(spark, tmp_path):
    def made(name, df):
        checksums.write_checksum_tree(df, str(tmp_path / name), partitions=8)
        return str(tmp_path / name)

    return made


def test_differing_rows_are_named(spark, trees):
    base = spark.range(20_000).selectExpr("id", "concat('v', id % 7000) AS v").drop("id")
    left = trees("a", base)
    right = trees("b", base.where("v <> 'v17'").unionAll(spark.sql("SELECT 'v3' AS v UNION ALL SELECT 'new'")))
    got = {(r["left_rows"], r["right_rows"]) for r in checksums.checksum_diff(spark, left, right).collect()}
    assert got == {(3, 0), (3, 4), (0, 1)}
    prefixes = checksums.differing_prefixes(spark, left, right)
    assert prefixes.count() == 3
    rows = checksums.differing_rows(spark, left, prefixes)
    assert "GreaterThanOrEqual(`$_ref`" in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() < 20


def test_equal_empty_and_all_different(spark, trees, monkeypatch):
    one = spark.range(500).selectExpr("id AS v")
    a, b, none = trees("a", one), trees("b", one.orderBy(F.desc("v"))), trees("none", one.limit(0))
    assert checksums.checksum_diff(spark, a, b).isEmpty() and checksums.checksum_diff(spark, none, none).isEmpty()
    monkeypatch.setattr(checksums, "RANGES", 10)
    assert checksums.checksum_diff(spark, a, none).where("left_rows = 1 AND right_rows = 0").count() == 500
    with pytest.raises(ValueError):
        checksums.write_checksum_tree(one, a, depth=3)
