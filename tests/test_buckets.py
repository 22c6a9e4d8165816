"""A sync rewrites only the buckets that changed."""

from __future__ import annotations

from pathlib import Path

import pytest

from tidemark.plans import buckets
from tidemark.plans.buckets import BucketStore, read_bucket_history, read_buckets, sync_buckets, versions
from tidemark.plans.store import SnapshotStore, read_history, read_snapshot
from tidemark.plans.sync import sync_table

DAY = "2025-01-{:02d} 00:00:00"


def rows(spark, pairs, types="k long, v string"):
    return spark.createDataFrame(list(pairs), types)


def files(store, version):
    return sorted(p.parent.name for p in Path(store.data_path).glob(f"__written={version}/*/*.parquet"))


def held(df):
    return sorted(str(r.asDict()) for r in df.select(*sorted(f"`{c}`" for c in df.columns)).collect())


def test_one_changed_bucket_of_64(spark, tmp_path):
    store = BucketStore(str(tmp_path), ("k",), 64)
    base = {k: "a" for k in range(1000)}
    sync_buckets(rows(spark, base.items()), store, DAY.format(1))
    first = held(read_buckets(spark, store))
    assert len(set(files(store, 1))) == 64
    result = sync_buckets(rows(spark, (base | {7: "b"}).items()), store, DAY.format(2))
    assert len(files(store, 2)) == 1 and result.counts["update_rows"] == 1 and result.counts["no_change_rows"] == 999
    assert held(read_buckets(spark, store, 1)) == first
    latest = read_buckets(spark, store)
    assert sorted((r["k"], r["v"]) for r in latest.collect()) == sorted((base | {7: "b"}).items())
    assert latest.where("`$_operation` = 'NO_CHANGE'").count() == 999
    assert {str(r[0]) for r in latest.select("`$_timestamp`").distinct().collect()} == {DAY.format(2)}


def test_same_rows_as_a_plain_store(spark, tmp_path):
    store, plain = BucketStore(str(tmp_path / "b"), ("k", "m"), 5), SnapshotStore(str(tmp_path / "p"))
    types = "k long, m string, v double"
    steps = [
        [(i, "m", float(i)) for i in range(40)],
        [(i, "m", float(i)) for i in range(5, 45)] + [(6, None, 1.0), (7, "m", 7.0)],
        [(i, "m", float(i * (i == 9 or 1))) for i in range(5, 45)],  # nothing changes
        [(i, "m", -1.0) for i in range(3)],
    ]
    for day, step in enumerate(steps, 1):
        got = sync_buckets(rows(spark, step, types), store, DAY.format(day))
        want = sync_table(rows(spark, step, types), plain, ["k", "m"], DAY.format(day))
        assert held(read_buckets(spark, store)) == held(read_snapshot(spark, plain))
        assert got.counts == want.counts
    assert held(read_bucket_history(spark, store)) == held(read_history(spark, plain))


def test_retention_removes_only_what_nobody_names(spark, tmp_path):
    store, state = BucketStore(str(tmp_path), ("k",), 8), {k: "a" for k in range(100)}
    for day in range(1, 6):
        state = state | {day: f"v{day}"}
        sync_buckets(rows(spark, state.items()), store, DAY.format(day))
    assert versions(spark, store) == [4, 5]
    named = set().union(*[buckets.read_manifest(spark, store, v).paths(store) for v in (4, 5)])
    there = {str(p.parent) for p in Path(store.data_path).glob("*/*/*.parquet")}
    assert there == named and any("__written=1" in p for p in there)
    for version, day in ((4, 4), (5, 5)):
        got = {r["k"]: r["v"] for r in read_buckets(spark, store, version).collect()}
        assert got == {k: f"v{k}" if 1 <= k <= day else "a" for k in range(100)}


def test_crash_before_the_manifest_and_replay(spark, tmp_path, monkeypatch):
    store = BucketStore(str(tmp_path), ("k",), 4)
    sync_buckets(rows(spark, [(1, "a"), (2, "b")]), store, DAY.format(1), batch="j1")
    with monkeypatch.context() as patch:
        patch.setattr(buckets, "write_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            sync_buckets(rows(spark, [(1, "x"), (2, "b")]), store, DAY.format(2), batch="j2")
    assert versions(spark, store) == [1] and read_bucket_history(spark, store).count() == 2
    done = sync_buckets(rows(spark, [(2, "b"), (3, "c")]), store, DAY.format(2), batch="j2")
    after = held(read_buckets(spark, store))
    assert sync_buckets(rows(spark, [(9, "?")]), store, DAY.format(1), batch="j2") == done
    assert sync_buckets(rows(spark, [(9, "?")]), store, DAY.format(1), batch="j1").version == 1
    assert held(read_buckets(spark, store)) == after and versions(spark, store) == [1, 2]
    with pytest.raises(ValueError, match="before"):
        sync_buckets(rows(spark, [(9, "?")]), store, DAY.format(1))
    assert sync_buckets(rows(spark, [(9, "?")]), store, DAY.format(1), stale="skip").status == "skipped"


def test_another_layout_or_schema_rewrites_all(spark, tmp_path):
    sync_buckets(rows(spark, [(k, "a") for k in range(20)]), BucketStore(str(tmp_path), ("k",), 4), DAY.format(1))
    wider = BucketStore(str(tmp_path), ("k",), 6)
    sync_buckets(rows(spark, [(k, "a") for k in range(20)]), wider, DAY.format(2))
    assert set(buckets.read_manifest(spark, wider, 2).buckets.values()) == {2}
    drifted = rows(spark, [(k, "a", 1) for k in range(1, 20)], "k string, v string, w int")
    result = sync_buckets(drifted, wider, DAY.format(3))
    got = read_buckets(spark, wider)
    assert result.counts["delete_rows"] == 1 and result.counts["update_rows"] == 19 and dict(got.dtypes)["w"] == "int"
    assert read_buckets(spark, BucketStore(str(tmp_path / "none"), ("k",))) is None


def test_empty_source_and_key_beyond_the_schema(spark, tmp_path):
    store = BucketStore(str(tmp_path), ("k",), 4)
    sync_buckets(rows(spark, []), store, DAY.format(1))
    assert read_buckets(spark, store).count() == 0
    sync_buckets(rows(spark, [(1, "a")]), store, DAY.format(2))
    sync_buckets(rows(spark, []), store, DAY.format(3))
    assert [r["$_operation"] for r in read_buckets(spark, store).collect()] == ["DELETE"]
    sync_buckets(rows(spark, []), store, DAY.format(4))
    assert read_buckets(spark, store).count() == 0
