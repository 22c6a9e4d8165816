from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cdc, history, keys, metrics, projection

T1, T2 = "2025-01-01 00:00:00", "2025-01-02 00:00:00"
SCHEMA = "k1 int, k2 string, v double"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def random_rows(seed, size=60):
    rng = random.Random(seed)
    return [
        (rng.choice([None, *range(8)]), rng.choice([None, "a", "b", ""]), rng.choice([None, 0.5, 1.5]))
        for _ in range(size)
    ]


def test_compare_with_itself_changes_nothing(spark):
    cur = frame(spark, random_rows(1))
    out = cdc.cdc_compare(cur, projection.snapshot(cur, now=T1), ["k1", "k2"], T2)
    assert {r[0] for r in out.select("`$_operation`").collect()} == {"NO_CHANGE"}
    assert {str(r[0]) for r in out.select("`$_last_updated`").collect()} == {T1}


@pytest.mark.parametrize("seed", range(4))
def test_compare_against_brute_force(spark, seed):
    old_rows, new_rows = random_rows(seed), random_rows(seed + 100)
    out = cdc.cdc_compare(
        frame(spark, new_rows), projection.snapshot(frame(spark, old_rows), now=T1), ["k1", "k2"], T2
    ).collect()

    def keyed(rows):
        groups: dict = {}
        for r in rows:
            if r[0] is not None and r[1] is not None:
                groups.setdefault(r[:2], []).append(r)
        return groups

    old, new = keyed(old_rows), keyed(new_rows)
    assert {(r["k1"], r["k2"]) for r in out} == set(old) | set(new)
    assert len(out) == len(set(old) | set(new))
    for r in out:
        key, op = (r["k1"], r["k2"]), r["$_operation"]
        assert (r["k1"], r["k2"], r["v"]) in (new.get(key) or old[key])
        if key not in old:
            assert op == "INSERT" and str(r["$_last_updated"]) == T2
        elif key not in new:
            assert op == "DELETE" and str(r["$_last_updated"]) == T1
        else:
            assert op in ("UPDATE", "NO_CHANGE")
            assert str(r["$_last_updated"]) == (T2 if op == "UPDATE" else T1)
        assert str(r["$_timestamp"]) == T2


def test_changes_applied_to_old_give_new(spark):
    old, new = frame(spark, random_rows(7)), frame(spark, random_rows(8))
    pair = ["k1", "k2"]
    old_rows = keys.dedup_by_key(keys.keys_not_null(old, pair), pair)
    new_rows = keys.dedup_by_key(keys.keys_not_null(new, pair), pair)
    out = cdc.cdc_compare(new, projection.snapshot(old, now=T1), pair, T2)
    live = cdc.live_rows(out).select("k1", "k2", "v")
    assert Counter(live.collect()) == Counter(new_rows.collect())
    counts = metrics.sync_metrics(out).first()
    assert counts["rows"] == old_rows.select(*pair).union(new_rows.select(*pair)).distinct().count()
    assert counts["rows"] == sum(counts[f"{o.lower()}_rows"] for o in metrics.OPERATIONS)


def test_cleared_value_stays_null(spark):
    out = cdc.cdc_compare(
        frame(spark, [(1, "a", None)]), projection.snapshot(frame(spark, [(1, "a", 2.0)]), now=T1), ["k1", "k2"], T2
    ).first()
    assert out["v"] is None and out["$_operation"] == "UPDATE"


def test_drift_of_columns_and_types(spark):
    old = projection.snapshot(spark.createDataFrame([("1", 5, "x"), ("2", 6, "y")], "k string, a int, gone string"), now=T1)
    new = spark.createDataFrame([(1, 5, 0.5)], "k int, a long, extra double")
    out = {r["k"]: r for r in cdc.cdc_compare(new, old.drop("$_last_updated"), ["k"], T2).collect()}
    assert set(out[1].asDict()) == {"k", "a", "extra", "$_ref", "$_operation", "$_timestamp", "$_last_updated"}
    assert out[1]["$_operation"] == "UPDATE" and out[2]["$_operation"] == "DELETE"
    assert out[2]["a"] == 6 and out[2]["extra"] is None and str(out[2]["$_last_updated"]) == T2


def test_repeated_keys_keep_the_same_row_on_both_sides(spark):
    rows = frame(spark, [(1, "a", float(v)) for v in range(20)])
    latest = F.col("v").desc()
    out = cdc.cdc_compare(rows, projection.snapshot(rows, now=T1), ["k1"], T2, latest).collect()
    assert [(r["v"], r["$_operation"]) for r in out] == [(19.0, "NO_CHANGE")]
    newer = rows.withColumn("at", F.col("v"))
    out = cdc.cdc_compare(newer, projection.snapshot(rows, now=T1), ["k1"], T2, F.col("at").desc()).collect()
    assert [(r["v"], r["$_operation"]) for r in out] == [(19.0, "UPDATE")]


def test_nan_is_a_key(spark):
    df = spark.createDataFrame([(float("nan"), 1), (None, 2)], "k double, v int")
    assert keys.keys_not_null(df, ["k"]).count() == 1
    out = cdc.cdc_compare(df, projection.snapshot(df, now=T1), ["k"], T2).collect()
    assert [r["$_operation"] for r in out] == ["NO_CHANGE"]


def test_dedup_keeps_the_chosen_row_and_is_stable(spark):
    rows = [(1, "a", float(i)) for i in range(50)] + [(1, "b", None), (1, "b", None)]
    for shuffled in (rows, rows[::-1]):
        df = frame(spark, shuffled).repartition(3)
        first = {r["k2"]: r["v"] for r in keys.dedup_by_key(df, ["k1", "k2"], F.col("v").desc()).collect()}
        assert first == {"a": 49.0, "b": None}
        assert keys.dedup_by_key(df, ["k1", "k2"]).orderBy("k2").collect() == keys.dedup_by_key(
            frame(spark, rows), ["k1", "k2"]
        ).orderBy("k2").collect()


def test_hash_compare_keeps_repeats(spark):
    old = cdc.first_refresh(frame(spark, [(1, "a", 1.0)] * 3 + [(2, "b", 2.0)] * 2), T1)
    out = cdc.hash_cdc(frame(spark, [(1, "a", 1.0)] * 4 + [(3, "c", 3.0)]), old, T2).collect()
    got = Counter((r["k1"], r["$_operation"], str(r["$_timestamp"]), str(r["$_last_updated"])) for r in out)
    assert got == {(1, "INSERT", T1, T1): 4, (3, "INSERT", T2, T2): 1, (2, "DELETE", T1, T2): 2}


def test_history_replay_adds_nothing(spark):
    old = projection.snapshot(frame(spark, [(1, "a", 1.0), (2, "b", 2.0), (2, "b", 2.0)]), now=T1)
    first = history.append_history(old, None, T1)
    assert first.count() == 2
    out = cdc.cdc_compare(frame(spark, [(1, "a", 9.0)]), old, ["k1", "k2"], T2)
    second = history.append_history(out, first, T2, distinct_history=True)
    assert Counter(r["$_operation"] for r in second.collect()) == {"INSERT": 2, "UPDATE": 1, "DELETE": 1}
    for distinct in (True, False):
        assert history.append_history(out, second, T2, distinct_history=distinct).count() == 4


def test_checksum(spark):
    df = frame(spark, random_rows(3))
    whole = metrics.table_checksum(projection.with_row_hash(df)).first()
    assert metrics.table_checksum(projection.with_row_hash(df.repartition(5))).first() == whole
    assert metrics.table_checksum(df).first() == whole
    assert metrics.table_checksum(df.unionAll(df.limit(1))).first()["checksum"] != whole["checksum"]
    assert metrics.table_checksum(df.limit(0)).first().asDict() == {"checksum": "empty", "row_count": 0}


def test_fingerprints_are_shuffled_short_and_come_back_whole(spark):
    """Also those that are no 32 lower-case digits."""
    marks = ["0" * 32, "0f" * 16, "0F" * 16, "a" * 16, "", "\u00fc" * 8, "\0" * 16, "0f" * 16 + "\n", None]
    rows = spark.createDataFrame([(i, m) for i, m in enumerate(marks)], "v int, `$_ref` string").repartition(3)
    before = cdc.first_refresh(rows.where("v % 3 <> 0"), T1)
    out = cdc.hash_cdc(rows.where("v % 3 <> 1"), before, T2)
    assert "unhex" in out._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r["v"], r["$_ref"], r["$_operation"], r["$_timestamp"] == r["$_last_updated"]) for r in out.collect() if r["$_ref"] is not None)
    told = [(i, m, "DELETE" if i % 3 == 1 else "INSERT", i % 3 != 1) for i, m in enumerate(marks) if m is not None]
    assert got == told
