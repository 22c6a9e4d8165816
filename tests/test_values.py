"""Keys of numbers, and one meaning of a partition value in filters, single and bulk extracts."""

from __future__ import annotations

from decimal import Decimal, localcontext

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import number_key, number_key_column, value_key, value_key_column
from tidemark.operators import partitions
from tidemark.plans import extracts

TEXTS = [
    "7", "007", "7e0", "7.0", "+7", " 7 ", "70e-1", "7e99", "70E98", "1" * 25, "1" * 25 + ".0", "-0", "0", "0e5", "-.5", "-0.50",
    ".", "", "e5", "7e", "7e9999999999", "1e25", "x7", "-7", "-70", "-7.1", "0.001", "1e-3", "٣", "7_0", "0x10", "nan", "-1e-400",
]


def test_column_and_plan_agree(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS] + [(None,)], "t string")
    for made, plain in ((number_key_column, number_key), (value_key_column, value_key)):
        got = {r["t"]: r["k"] for r in df.select("t", made(F.col("t")).alias("k")).collect()}
        assert got == {t: plain(t) for t in TEXTS} | {None: None}


numbers = st.decimals(allow_nan=False, allow_infinity=False, places=None)


@settings(max_examples=300, deadline=None)
@given(a=numbers, b=numbers)
def test_keys_sort_like_numbers(a, b):
    x, y = number_key(str(a)), number_key(str(b))
    with localcontext() as exact:
        exact.prec = 2000
        assert (x < y) == (a < b) and (x == y) == (a == b)


def test_every_value_finds_itself_and_its_extract(spark, tmp_path):
    values = [t for t in TEXTS if t] + [""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(values)] + [(99, None)], "i long, v string")
    base = str(tmp_path)
    extracts.build_all_partitions({"t": df}, "v", base, "bulk")
    for text in ("7", "7e99", "1e25", "1" * 25, "-0", "x7", "-.5", "."):
        single = sorted(r["i"] for r in partitions.partition_filter(df, "v", text).collect())
        assert values.index(text) in single
        assert single == sorted(i for i, t in enumerate(values) if value_key(t) == value_key(text))
        bulk = spark.read.schema(df.schema).parquet(extracts.extract_path(base, "bulk", text, "t"))
        assert sorted(r["i"] for r in bulk.collect()) == single


def test_other_types(spark):
    row = spark.range(1).selectExpr("7L AS l", "CAST(7.50 AS DECIMAL(9,2)) AS d", "7.5D AS x", "true AS b", "DATE'2024-01-02' AS t")

    def found(column, value):
        return partitions.partition_filter(row, column, value).count() == 1

    assert found("l", "7") and found("l", "007") and found("l", "7.0") and found("l", "70e-1")
    assert not found("l", "7.4") and not found("l", "7e99") and not found("l", "1" * 25) and not found("l", "x")
    assert found("d", "7.5") and found("d", "75e-1") and not found("d", "7.501") and found("x", "7.50") and found("b", "1")
    assert not found("b", "0") and found("t", "2024-01-02") and not found("t", "none")


def test_a_stored_key_is_pushed_to_the_scan(spark, tmp_path):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i long, v string")
    partitions.with_value_key(df, "v").write.parquet(str(tmp_path / "k"))
    stored = spark.read.parquet(str(tmp_path / "k"))
    got = partitions.partition_filter(stored, "v", "07")
    assert "EqualTo(`$_value_key v`,n2" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["i"] for r in got.collect()) == sorted(r["i"] for r in partitions.partition_filter(df, "v", "7").collect())
