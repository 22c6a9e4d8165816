"""Fingerprints of nested values."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import HASH_COLUMN, row_hash
from tidemark.operators import cdc, projection

TYPES = {
    "array": "array<string>",
    "maps": "map<string,int>",
    "deep": "struct<a:array<map<string,array<double>>>,b:struct<c:string,d:map<int,string>>>",
    "bytes": "array<binary>",
}


def value(rnd, kind):
    def some(make):
        return None if rnd.random() < 0.15 else make()

    text = lambda: rnd.choice(["", "a", "b", "1", ",", "a,b", "~", "1:a", "null", "[]"])
    few = lambda make: [make() for _ in range(rnd.randrange(3))]
    if kind == "array":
        return some(lambda: few(lambda: some(text)))
    if kind == "maps":
        return some(lambda: {text(): some(lambda: rnd.randrange(3)) for _ in range(rnd.randrange(4))})
    if kind == "bytes":
        return some(lambda: few(lambda: some(lambda: bytes([rnd.randrange(250, 256)]))))
    inner = lambda: few(lambda: some(lambda: rnd.choice([0.5, 1e16, 1e-9, float("inf")])))
    maps = lambda: few(lambda: some(lambda: {text(): some(inner) for _ in range(rnd.randrange(3))}))
    return some(lambda: (some(maps), some(lambda: (some(text), some(lambda: {rnd.randrange(4): some(text) for _ in range(rnd.randrange(3))})))))


def turned(v):
    """The same value with the entries of its maps in another order."""
    if isinstance(v, dict):
        return {k: turned(x) for k, x in reversed(v.items())}
    if isinstance(v, (list, tuple)):
        return type(v)(turned(x) for x in v)
    return v


def plain(v):
    if isinstance(v, dict):
        return ("map", frozenset((k, plain(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return (type(v).__name__, tuple(plain(x) for x in v))
    return v


@pytest.mark.parametrize("kind", TYPES)
def test_equal_values_and_only_those_share_a_fingerprint(spark, kind):
    rnd = random.Random(7)
    values = [value(rnd, kind) for _ in range(250)]
    rows = [(i, v) for i, v in enumerate(values)] + [(i, turned(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {TYPES[kind]}")
    refs: dict = {}
    for r in df.select("i", row_hash(df, ["v"]).alias("r")).collect():
        refs.setdefault(r["r"], set()).add(r["i"])
    by_ref = {}
    for ref, members in refs.items():
        kinds = {plain(values[i]) for i in members}
        assert len(kinds) == 1
        assert by_ref.setdefault(kinds.pop(), ref) == ref


def test_a_reader_that_turns_maps_makes_no_update(spark):
    old = projection.snapshot(spark.range(1).select("id", F.expr("map('a', 1, 'b', 2) AS m")), now="2025-01-01 00:00:00")
    new = spark.range(1).select("id", F.expr("map('b', 2, 'a', 1) AS m"))
    got = cdc.cdc_compare(new, old, ["id"], "2025-01-02 00:00:00").first()
    assert got["$_operation"] == "NO_CHANGE" and got[HASH_COLUMN]
