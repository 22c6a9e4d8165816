"""Snapshot, history and marker of a sync are one commit."""

from __future__ import annotations

import json

import pytest

from tidemark.operators.models import build_model
from tidemark.plans import sync as sync_module
from tidemark.plans.store import SnapshotStore, read_history, read_snapshot, versions
from tidemark.plans.sync import sync_table
from tidemark.streaming.arrivals import stream_jobs, stream_sync

DAY = "2025-01-{:02d} 00:00:00"


def rows(spark, *pairs, types="k long, v string"):
    return spark.createDataFrame(list(pairs), types)


def told(df):
    """Key, value and operation of each row."""
    return sorted((str(r["k"]), r["v"], r["$_operation"]) for r in df.select("k", "v", "`$_operation`").collect())


@pytest.mark.parametrize("broken", ["write_history", "mark_batch"])
def test_failure_before_the_marker_loses_nothing(spark, tmp_path, monkeypatch, broken):
    store = SnapshotStore(str(tmp_path))
    sync_table(rows(spark, (1, "a"), (2, "b")), store, ["k"], DAY.format(1), batch="s-0")
    second = rows(spark, (1, "x"), (3, "c"))
    with monkeypatch.context() as patch:

        def fail(*args):
            raise OSError("lost")

        patch.setattr(sync_module, broken, fail)
        with pytest.raises(OSError):
            sync_table(second, store, ["k"], DAY.format(2), batch="s-1")
    assert [v.number for v in versions(spark, store)] == [1]
    assert told(read_history(spark, store)) == [("1", "a", "INSERT"), ("2", "b", "INSERT")]
    result = sync_table(second, store, ["k"], DAY.format(2), batch="s-1")
    assert result.version == 2 and result.counts["update_rows"] == 1
    assert ("1", "x", "UPDATE") in told(read_history(spark, store)) and ("2", "b", "DELETE") in told(read_history(spark, store))


def test_repeat_without_changes_takes_its_history_back(spark, tmp_path):
    store = SnapshotStore(str(tmp_path))
    sync_table(rows(spark, (1, "a")), store, ["k"], DAY.format(1))
    sync_table(rows(spark, (1, "b")), store, ["k"], DAY.format(2), version=2)
    sync_table(rows(spark, (1, "a")), store, ["k"], DAY.format(2), version=2)
    assert told(read_snapshot(spark, store)) == [("1", "a", "NO_CHANGE")]
    assert told(read_history(spark, store)) == [("1", "a", "INSERT")]


def test_order_of_versions_and_times(spark, tmp_path):
    store = SnapshotStore(str(tmp_path))
    for day in (1, 2, 3):
        sync_table(rows(spark, (1, str(day))), store, ["k"], DAY.format(day))
    with pytest.raises(ValueError, match="below the latest"):
        sync_table(rows(spark, (1, "old")), store, ["k"], DAY.format(9), version=2)
    with pytest.raises(ValueError, match="before"):
        sync_table(rows(spark, (1, "old")), store, ["k"], DAY.format(2))
    skipped = sync_table(rows(spark, (1, "old")), store, ["k"], DAY.format(2), stale="skip")
    assert (skipped.version, skipped.status) == (3, "skipped")
    assert told(read_snapshot(spark, store)) == [("1", "3", "UPDATE")]


def test_counts_and_bytes(spark, tmp_path):
    store = SnapshotStore(str(tmp_path))
    sync_table(rows(spark, (1, "a"), (2, "b"), (7, "gone")), store, ["k"], DAY.format(1))
    result = sync_table(rows(spark, (1, "a"), (1, "a2"), (1, "a3"), (None, "n"), (2, "b")), store, ["k"], DAY.format(2))
    assert (result.counts["null_key_rows"], result.counts["repeated_key_rows"]) == (1, 2)
    assert result.counts["delete_rows"] == 1 and result.bytes > 0


def test_stream_with_a_lost_checkpoint_goes_on(spark, tmp_path):
    inbox, store = str(tmp_path / "in"), SnapshotStore(str(tmp_path / "s"))

    def run(checkpoint, day):
        stream_sync(spark, inbox, "k long, v string", ["k"], store, str(tmp_path / checkpoint), clock=lambda _: DAY.format(day)).awaitTermination()

    rows(spark, (1, "a"), (2, "b")).coalesce(1).write.mode("append").parquet(inbox)
    run("one", 1)
    rows(spark, (1, "x")).coalesce(1).write.mode("append").parquet(inbox)
    run("one", 2)
    history = read_history(spark, store).count()
    assert [v.number for v in versions(spark, store)] == [1, 2]
    run("two", 3)
    assert [v.number for v in versions(spark, store)] == [3, 4]
    assert read_history(spark, store).count() > history


def test_jobs_out_of_order_and_several_in_a_file(spark, tmp_path):
    store, inbox, seen = SnapshotStore(str(tmp_path / "s")), tmp_path / "jobs", []
    inbox.mkdir()
    paths = {}
    for day in (1, 2, 3):
        paths[day] = str(tmp_path / f"d{day}.parquet")
        rows(spark, (1, f"v{day}")).write.parquet(paths[day])

    def jobs(name, *days):
        lines = [json.dumps({"path": paths[d], "synced_at": DAY.format(d)}) for d in days]
        (inbox / name).write_text("\n".join(lines) + "\n")
        query = stream_jobs(spark, str(inbox), ["k"], store, str(tmp_path / "cp"), on_result=lambda p, r: seen.append((p, r.status)))
        query.awaitTermination()

    jobs("a.json", 3, 1)
    jobs("b.json", 2)
    assert seen == [(paths[1], "completed"), (paths[3], "completed"), (paths[2], "skipped")]
    assert told(read_snapshot(spark, store)) == [("1", "v3", "UPDATE")]


def test_history_survives_type_changes(spark, tmp_path):
    store = SnapshotStore(str(tmp_path))
    sync_table(rows(spark, (1, 5), types="k int, v int"), store, ["k"], DAY.format(1))
    sync_table(rows(spark, (1, 2**40), types="k long, v long"), store, ["k"], DAY.format(2))
    history = read_history(spark, store)
    assert dict(history.dtypes)["k"] == "bigint" and sorted(r["v"] for r in history.collect()) == [5, 2**40]
    sync_table(rows(spark, (1, "text")), store, ["k"], DAY.format(3))
    history = read_history(spark, store)
    assert sorted(r["v"] for r in history.collect()) == sorted(["5", str(2**40), "text"])


def test_a_key_that_does_not_fit_its_new_type_is_an_error(spark, tmp_path):
    store = SnapshotStore(str(tmp_path))
    sync_table(rows(spark, ("7", "a"), ("abc", "b"), types="k string, v string"), store, ["k"], DAY.format(1))
    with pytest.raises(Exception, match="key k: previous value is string and does not fit bigint: abc"):
        sync_table(rows(spark, (7, "a")), store, ["k"], DAY.format(2))
    assert [v.number for v in versions(spark, store)] == [1]
    sync_table(rows(spark, ("7", "a"), types="k string, v string"), store, ["k"], DAY.format(2))
    assert ("abc", "b", "DELETE") in told(read_history(spark, store))


def test_views_do_not_stay(spark):
    one = rows(spark, (1, "a"))
    rows(spark, (9, "mine")).createOrReplaceTempView("first")
    pick = {"type": "custom", "sql": "SELECT k FROM first"}
    assert build_model(spark, pick, {"first": one}).collect() == [(1,)]
    assert spark.table("first").collect() == [(9, "mine")]
    spark.catalog.dropTempView("first")
    built = build_model(spark, pick, {"first": one})
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        build_model(spark, pick, {"second": one})
    assert built.collect() == [(1,)]
