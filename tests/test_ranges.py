"""Range joins against a comparison of all pairs."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.models import build_model
from tidemark.operators.ranges import range_join


def values(rnd, n):
    odd = [None, 0.0, -0.0, 1e300, -1e300, math.inf, -math.inf, math.nan, 5e-324, 2.0**53 + 2, 0.1]
    return [rnd.choice(odd) if rnd.random() < 0.2 else round(rnd.uniform(-50, 50), rnd.choice([0, 3])) for _ in range(n)]


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("closed", ["both", "left", "right", "neither"])
def test_against_all_pairs(spark, how, closed):
    rnd = random.Random(3)
    points = [(i, v) for i, v in enumerate(values(rnd, 60))]
    ends = list(zip(values(rnd, 60), values(rnd, 60)))
    ends += [(-math.inf, math.inf), (-1e308, 1e308), (0.0, 0.0), (3.0, 3.0), (3.0, 3.0)]
    spans = [(i, a, b if a is None or b is None or rnd.random() < 0.5 else max(a, b)) for i, (a, b) in enumerate(ends)]

    def inside(x, a, b):
        if any(v is None or math.isnan(v) for v in (x, a, b)):
            return False
        return (a <= x if closed in ("both", "left") else a < x) and (x <= b if closed in ("both", "right") else x < b)

    want = {(i, j) for i, x in points for j, a, b in spans if inside(x, a, b) and a <= b}
    if how in ("left", "full"):
        want |= {(i, None) for i, _ in points if i not in {p for p, _ in want}}
    if how in ("right", "full"):
        want |= {(None, j) for j, *_ in spans if j not in {s for _, s in want}}
    left = spark.createDataFrame(points, "p long, v double")
    right = spark.createDataFrame(spans, "s long, a double, b double")
    got = range_join(left, right, "v", "a", "b", how, closed)
    assert got.columns == ["p", "v", "s", "a", "b"]
    rows = [(r["p"], r["s"]) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


@pytest.mark.parametrize("types", ["int", "long", "decimal(10,2)", "date", "timestamp", "timestamp_ntz"])
def test_types_and_empty_sides(spark, types):
    made = spark.range(20).select(F.col("id").alias("n"))
    if types in ("date", "timestamp", "timestamp_ntz"):
        at = F.date_add(F.lit("2024-01-01").cast("date"), F.col("n").cast("int")).cast(types)
    else:
        at = F.col("n").cast(types)
    left = made.select("n", at.alias("v"))
    right = left.where("n IN (3, 9)").agg(F.min("v").alias("a"), F.max("v").alias("b"))
    assert sorted(r["n"] for r in range_join(left, right, "v", "a", "b").collect()) == list(range(3, 10))
    assert range_join(left, right.limit(0), "v", "a", "b").count() == 0
    assert range_join(left, right.limit(0), "v", "a", "b", "left").count() == 20
    assert range_join(left.limit(0), right, "v", "a", "b").count() == 0


MODELS = {"inner": "f.v BETWEEN t.a AND t.b", "bounds": "v >= a AND f.v < t.b", "turned": None}


@pytest.mark.parametrize("case", MODELS)
def test_models_on_a_range_have_no_nested_loop(spark, case):
    f = spark.range(300).selectExpr("id AS k", "CAST(id AS double) / 7 AS v")
    t = spark.createDataFrame([(i, i * 2.0, i * 2.0 + 5) for i in range(20)] + [(99, -1e9, 1e9)], "s long, a double, b double")
    models, on, first = {"f": f, "t": t}, MODELS[case], "f"
    if case == "turned":
        on, first = "v BETWEEN a AND b", "t"
    other = "t" if first == "f" else "f"
    definition = {"type": "join", "from": first, "joins": [{"type": "INNER", "table": other, "on": on}]}
    got = build_model(spark, definition, models)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    plain = build_model(spark, {"type": "custom", "sql": f"SELECT * FROM {first} JOIN {other} ON {on}"}, models)
    assert sorted(got.columns) == sorted(plain.columns)
    assert sorted(map(tuple, got.select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))
    assert got.where("s = 99").count() == 300


def test_other_conditions_stay(spark):
    f, t = spark.range(5).selectExpr("id AS k"), spark.range(5).selectExpr("id AS a", "id + 1 AS b", "'x' AS c")
    for on in ("k BETWEEN a AND a + 1", "k BETWEEN a AND c", "k > a", "k >= a AND a < b"):
        for kind in ("INNER", "LEFT"):
            definition = {"type": "join", "from": "f", "joins": [{"type": kind, "table": "t", "on": on}]}
            if on.endswith("AND c"):
                continue
            assert build_model(spark, definition, {"f": f, "t": t}).columns == ["k", "a", "b", "c"]
