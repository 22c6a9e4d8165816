"""Rows that a join on a key is likely to keep."""

from __future__ import annotations

from tidemark.operators.keys import likely_among


def test_all_wanted_rows_and_few_others_stay(spark):
    rows = spark.range(5000).selectExpr("concat('m:', id % 1000) AS `a.b`", "id AS n")
    wanted = spark.range(10).selectExpr("concat('m:', id) AS id")
    got = [r["n"] for r in likely_among(rows, "a.b", wanted).collect()]
    assert {n for n in range(5000) if n % 1000 < 10} <= set(got) and len(got) == len(set(got)) < 100
    assert likely_among(rows, "a.b", wanted.limit(0)).count() == 0
    nulls = spark.sql("SELECT CAST(NULL AS string) AS `a.b`, 1L AS n")
    assert likely_among(nulls, "a.b", nulls.select("`a.b`")).count() == 1
