from __future__ import annotations

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import (
    expand_file_name,
    is_internal_column,
    row_hash,
    safe_cast,
    sanitize_name,
    text_form,
    unique_names,
    wildcard_to_regex,
    zero_date_to_null,
)

TEXTS = [
    "1", " 1 ", "+1", "-1", "1.5", "2.5", "-1.5", "-2.5", "0.49999999999", "1e3", "1.", ".5", "abc", "", " ", None, "1d", "1f",
    "0x1p3", "inf", "-Infinity", "nan", "9223372036854775807", "9223372036854775808", "1e30", "true", "FALSE", "t", "f", "yes",
    "no", "y", "n", "0", "2024-02-30", "2024-02-29", "2024", "2024-01", "2024/01/02", "2024-1-2", "2024-01-02 03:04:05",
    "2024-01-02T03:04:05", "2024-01-02 03:04:05.123456", "12:00:00", "2024-01-02 25:00:00", "0000-00-00", "1-2-3 x",
]

DUCK_TYPES = {"double": "DOUBLE", "bigint": "BIGINT", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP"}
# Spark has no infinite dates.
NO_DATE = {"inf", "-Infinity"}


@pytest.mark.parametrize("type_name", DUCK_TYPES)
def test_safe_cast_text_agrees_with_sql_engine(spark, type_name):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    got = {r["i"]: r["v"] for r in df.select("i", safe_cast(F.col("t"), type_name).cast("string").alias("v")).collect()}
    con = duckdb.connect()
    for i, text in enumerate(TEXTS):
        want = con.execute(f"SELECT TRY_CAST(? AS {DUCK_TYPES[type_name]})", [text]).fetchone()[0]
        if type_name in ("date", "timestamp") and text in NO_DATE:
            want = None
        if type_name == "double":
            assert (None if got[i] is None else repr(float(got[i]))) == (None if want is None else repr(want)), text
        elif isinstance(want, bool):
            assert got[i] == str(want).lower(), text
        else:
            assert got[i] == (None if want is None else str(want)), text


def test_safe_cast_zoned_time_keeps_the_wall_clock(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05+02",)], "t string")
    assert df.select(safe_cast(F.col("t"), "timestamp")).first()[0] == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_safe_cast_numbers_round(spark):
    df = spark.createDataFrame([(1.5,), (2.5,), (-1.5,), (1e30,), (float("nan"),)], "d double")
    got = [r[0] for r in df.select(safe_cast(F.col("d"), "int", T.DoubleType())).collect()]
    assert got == [2, 2, -2, None, None]
    dec = df.where("d < 10").select(F.col("d").cast("decimal(10,2)").alias("d"))
    assert [r[0] for r in dec.select(safe_cast(F.col("d"), "int", T.DecimalType(10, 2))).collect()] == [2, 3, -2]


def test_unknown_type_is_left_alone(spark):
    df = spark.createDataFrame([("x",)], "t string")
    assert df.select(safe_cast(F.col("t"), "varchar"), safe_cast(F.col("t"), None)).first() == ("x", "x")


def test_zero_dates(spark):
    rows = [
        "0000-00-00", "0000-00-00 00:00:00", "0000-00-00T00:00:00Z", "", "NULL", None, "0001-01-01 00:00:00",
        "0001-01-01", "0001-01-02 00:00:00", "1999-01-01 00:00:00", "abc-01-01 00:00:00",
    ]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    got = [r[0] for r in df.select(zero_date_to_null(F.col("t"), "timestamp")).collect()]
    assert got == [None] * 7 + rows[7:]
    assert df.select(zero_date_to_null(F.col("t"), "text")).first()[0] == "0000-00-00"
    typed = spark.sql("SELECT timestamp_ntz '0001-01-01 00:00:00' AS ts, date '0001-01-01' AS d")
    out = typed.select(zero_date_to_null(F.col("ts"), "datetime"), zero_date_to_null(F.col("d"), "date")).first()
    assert out[0] is None and out[1] == dt.date(1, 1, 1)


NUMBERS = [
    0.0, 1.0, -1.5, 0.1, 123.456, 9999999.0, 1e7, 12345678.9, 1e15, 123456789012345.6, 1e16, 1.5e17, 1.371158e17, 1e100, 1e300,
    0.001, 0.0009, 0.00012345, 0.0001, 1e-5, 1.5e-5, 1e-10, 1e-300, -1e-5, -1e20, -12345678.5, 1.7976931348623157e308,
    float("inf"), float("-inf"), float("nan"),
]


def test_text_of_floating_point_agrees_with_sql_engine(spark):
    con = duckdb.connect()
    for spark_type, duck_type in (("double", "DOUBLE"), ("float", "FLOAT")):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(NUMBERS)], "i int, v double").selectExpr(
            "i", f"CAST(v AS {spark_type}) AS v"
        )
        got = {r["i"]: r["t"] for r in df.select("i", text_form(F.col("v"), df.schema["v"].dataType).alias("t")).collect()}
        for i, v in enumerate(NUMBERS):
            if duck_type == "FLOAT" and (1e14 < abs(v) < float("inf") or 0 < abs(v) < 1e-40):
                continue  # out of range, or printed with more digits than needed by Java 17
            want = con.execute(f"SELECT CAST(CAST(CAST(? AS DOUBLE) AS {duck_type}) AS VARCHAR)", [v]).fetchone()[0]
            assert got[i] == want, (v, duck_type)


def test_hash_of_null_and_known_collisions(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "x"), ("", "x")], "p string, q string")
    h = [r[0] for r in df.select(row_hash(df, ["p", "q"])).collect()]
    assert h[0] == h[1] and h[2] == h[3] and h[0] != h[2]


def test_names():
    assert sanitize_name("Model Name-2") == "model_name_2"
    assert unique_names(["v", "V", "v_1", "v"]) == ["v", "V_2", "v_1", "v_3"]
    assert unique_names(["a", "a", "a"]) == ["a", "a_1", "a_2"]
    assert [is_internal_column(c) for c in ("_rowid", "$_ref", "$_ref_1", "address_1", "x1")] == [True, False, True, True, False]
    assert not is_internal_column("address_1", drop_numbered=False)
    assert wildcard_to_regex("a*.c?v") == r"a.*\.c.v"


def test_file_name_template():
    now = dt.datetime(2025, 1, 2, 3, 4, 5)
    got = expand_file_name("{model_name}_{date}_{timestamp}_{date}.csv", now, "m")
    assert got == "m_2025-01-02_1735787045000_2025-01-02.csv"
