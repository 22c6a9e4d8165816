"""A job that is done can run again any number of times without effect."""

from __future__ import annotations

import json

import pytest

from tidemark.operators import projection
from tidemark.plans import journal, outbound
from tidemark.plans import sync as sync_module
from tidemark.plans.store import SnapshotStore, read_history, read_snapshot, versions
from tidemark.plans.sync import sync_table
from tidemark.sources.storage import read_text, remove_folder, write_text
from tidemark.streaming.arrivals import stream_jobs

DAY = "2025-01-{:02d} 00:00:00"


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k long, v string")


def held(df):
    return sorted(map(str, df.collect()))


def test_a_batch_of_two_jobs_is_replayed(spark, tmp_path):
    store, inbox, seen = SnapshotStore(str(tmp_path / "s")), tmp_path / "jobs", []
    inbox.mkdir()
    lines = []
    for day in (1, 2):
        path = str(tmp_path / f"d{day}.parquet")
        rows(spark, (1, f"v{day}"), (day + 1, "x")).write.parquet(path)
        lines.append(json.dumps({"path": path, "synced_at": DAY.format(day)}))
    (inbox / "a.json").write_text("\n".join(lines) + "\n")

    def run():
        query = stream_jobs(spark, str(inbox), ["k"], store, str(tmp_path / "cp"), on_result=lambda p, r: seen.append(r))
        query.awaitTermination()

    run()
    before = held(read_snapshot(spark, store)), held(read_history(spark, store)), versions(spark, store)
    for _ in range(2):
        remove_folder(spark, str(tmp_path / "cp" / "commits"))  # the batch's end got lost
        run()
        assert (held(read_snapshot(spark, store)), held(read_history(spark, store)), versions(spark, store)) == before
    assert len(seen) == 6 and seen[0] == seen[2] == seen[4] and seen[1] == seen[3] == seen[5]


def test_earlier_exports_run_again(spark, tmp_path):
    store, log = SnapshotStore(str(tmp_path / "t")), str(tmp_path / "log")
    plan = outbound.WritePlan("reconcile", ("k",))

    def export(day):
        source = projection.snapshot(rows(spark, (1, f"v{day}"), (day + 10, "new")), now=DAY.format(day))
        return outbound.export_to_store(source, store, plan, DAY.format(day), f"j/{day}", changelog_path=log)

    results = {day: export(day) for day in (1, 2, 3, 4)}
    before = held(read_snapshot(spark, store)), held(outbound.read_changelog(spark, log)), versions(spark, store)
    for day in (2, 1, 4, 3, 1):
        assert export(day) == results[day]
    assert (held(read_snapshot(spark, store)), held(outbound.read_changelog(spark, log)), versions(spark, store)) == before


def test_a_job_that_died_before_its_entry_is_done(spark, tmp_path, monkeypatch):
    store = SnapshotStore(str(tmp_path))
    with monkeypatch.context() as patch:
        patch.setattr(journal, "finish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            sync_table(rows(spark, (1, "a")), store, ["k"], DAY.format(1), batch="b")
    assert journal.outcome(spark, store.base, "b") is None and journal.intent(spark, store.base, "b")["version"] == 1
    for day in (2, 3, 4):  # its version goes; the journal has the job by then
        sync_table(rows(spark, (1, f"v{day}")), store, ["k"], DAY.format(day))
    assert journal.outcome(spark, store.base, "b")["version"] == 1
    again = sync_table(rows(spark, (1, "old")), store, ["k"], DAY.format(1), batch="b")
    assert again.version == 1 and again.counts["rows"] == 1
    assert [r["v"] for r in read_snapshot(spark, store).collect()] == ["v4"]


def test_a_job_that_failed_runs(spark, tmp_path, monkeypatch):
    store = SnapshotStore(str(tmp_path))
    with monkeypatch.context() as patch:
        patch.setattr(sync_module, "write_history", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            sync_table(rows(spark, (1, "a")), store, ["k"], DAY.format(1), batch="b")
    assert sync_table(rows(spark, (1, "a")), store, ["k"], DAY.format(1), batch="b").version == 1


def test_names_and_files(spark, tmp_path):
    assert len({journal.job_name(x) for x in ("a/b", "a%2Fb", "a.b", "ab", "x" * 500, "x" * 499 + "y")}) == 6
    write_text(spark, f"{tmp_path}/n/one", "ä")
    write_text(spark, f"{tmp_path}/n/one", "later")
    assert read_text(spark, f"{tmp_path}/n/one") == "ä" and read_text(spark, f"{tmp_path}/n/two") is None
