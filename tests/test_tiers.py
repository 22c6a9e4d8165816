"""History and changelog in tiers."""

from __future__ import annotations

import os

import pytest

from tidemark.operators import projection
from tidemark.plans import outbound, tiers
from tidemark.plans.store import SnapshotStore, read_history, write_history
from tidemark.plans.sync import sync_table

DAY = "2025-01-{:02d} 00:00:00"


def units(spark, base, numbers, types="k long"):
    store = SnapshotStore(base)
    for n in numbers:
        write_history(spark.createDataFrame([(n,)], types), store, n)
    return store


def compacted(spark, store, below, fan=4):
    return tiers.compact(spark, store.history_path, lambda n: int(n.removeprefix("sync=")) < below, "snappy", fan)


def held(spark, store, latest=10_000):
    return sorted(r["k"] for r in read_history(spark, store, latest).collect())


def test_folders_grow_with_the_logarithm(spark, tmp_path):
    store = SnapshotStore(str(tmp_path))
    for n in range(1, 41):
        units(spark, str(tmp_path), [n])
        compacted(spark, store, n)
    assert held(spark, store) == list(range(1, 41))
    assert len(tiers.readable(spark, store.history_path)) <= 3 * 4 + 1
    assert (tmp_path / "history" / "sync=00000040").exists()  # the latest may be written again
    assert held(spark, store, 39) == list(range(1, 40))


@pytest.mark.parametrize("step", ["write_text", "remove_folder"])
def test_a_crash_between_tiers(spark, tmp_path, monkeypatch, step):
    store = units(spark, str(tmp_path), range(1, 18))
    for crash_at in (1, 2, 5):
        calls = []
        real = getattr(tiers, step)

        def fail(*args, real=real, calls=calls, crash_at=crash_at):
            calls.append(1)
            if len(calls) == crash_at:
                raise OSError("lost")
            return real(*args)

        with monkeypatch.context() as patch:
            patch.setattr(tiers, step, fail)
            try:
                compacted(spark, store, 17)
            except OSError:
                pass
        assert held(spark, store) == list(range(1, 18))
    compacted(spark, store, 17)
    assert held(spark, store) == list(range(1, 18))
    assert sorted(os.listdir(tmp_path / "history"))[-1] == "sync=00000017" and len(tiers.readable(spark, store.history_path)) == 2


def test_types_are_kept_apart(spark, tmp_path):
    store = units(spark, str(tmp_path), range(1, 4), "k int")
    units(spark, str(tmp_path), range(4, 6))
    assert compacted(spark, store, 9) == 1
    assert len(tiers.readable(spark, store.history_path)) == 3
    assert held(spark, store) == [1, 2, 3, 4, 5] and dict(read_history(spark, store, 9).dtypes)["k"] == "bigint"


def test_syncs_and_exports_compact_as_they_go(spark, tmp_path, monkeypatch):
    real = tiers.compact
    monkeypatch.setattr(tiers, "compact", lambda *a: real(*a, fan=3))
    store, log = SnapshotStore(str(tmp_path / "s")), str(tmp_path / "log")
    table, plan = SnapshotStore(str(tmp_path / "t")), outbound.WritePlan("append")
    for day in range(1, 6):
        rows = spark.createDataFrame([(1, f"v{day}")], "k long, v string")
        sync_table(rows, store, ["k"], DAY.format(day))
        source = projection.snapshot(rows, now=DAY.format(day))
        outbound.export_to_store(source, table, plan, DAY.format(day), f"job/{day}", changelog_path=log)
    assert sorted(r["v"] for r in read_history(spark, store).collect()) == [f"v{d}" for d in range(1, 6)]
    assert sorted(r["v"] for r in outbound.read_changelog(spark, log).collect()) == [f"v{d}" for d in range(1, 6)]
    assert len(os.listdir(log)) < 5 and len(os.listdir(tmp_path / "s" / "history")) < 5
