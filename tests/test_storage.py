from __future__ import annotations

import glob
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cdc, projection
from tidemark.operators.partitions import build_partition
from tidemark.plans.extracts import extract_path, write_partition
from tidemark.plans.outbound import export_to_csv
from tidemark.plans.refresh import refresh_table
from tidemark.plans.store import (
    Buckets,
    SnapshotStore,
    Version,
    _aligned,
    publish_snapshot,
    read_history,
    read_snapshot,
    versions,
)
from tidemark.plans.sync import sync_table, synced_rows
from tidemark.sinks.files import rows_per_file, write_csv, write_parquet
from tidemark.sinks.jdbc import write_options
from tidemark.sources.files import file_format, latest_file, read_csv, read_json, read_latest, read_source, resolve_path
from tidemark.sources.jdbc import Slices, jdbc_options, table_name
from tidemark.streaming.arrivals import stream_jobs, stream_sync

DAYS = [f"2025-01-0{d} 00:00:00" for d in range(1, 6)]


def table(spark, rows):
    return spark.createDataFrame(rows, "k long, v string")


def operations(df):
    return dict(Counter(r["$_operation"] for r in df.collect()))


@pytest.mark.parametrize("buckets", [None, Buckets(("k",), 3)])
def test_three_syncs(spark, tmp_path, buckets):
    store = SnapshotStore(str(tmp_path), buckets)
    first = sync_table(table(spark, [(1, "a"), (2, "b"), (2, "b"), (None, "n")]), store, ["k"], DAYS[0])
    assert first.counts["snapshot_rows"] == 4
    assert read_history(spark, store).count() == 3
    second = sync_table(table(spark, [(1, "a"), (3, "c")]), store, ["k"], DAYS[1])
    assert (second.counts["insert_rows"], second.counts["delete_rows"], second.counts["no_change_rows"]) == (1, 1, 1)
    # A deleted key that returns is an insert again, and a deletion is told once.
    third = sync_table(table(spark, [(1, "z"), (2, "b")]), store, ["k"], DAYS[2])
    assert operations(read_snapshot(spark, store)) == {"UPDATE": 1, "INSERT": 1, "DELETE": 1}
    assert third.version == 3 and [v.number for v in versions(spark, store)] == [2, 3]
    assert read_history(spark, store).count() == 3 + 2 + 3
    before = read_history(spark, store).collect()
    again = sync_table(table(spark, [(1, "z"), (2, "b")]), store, ["k"], DAYS[2], version=3)
    assert again == third and Counter(read_history(spark, store).collect()) == Counter(before)
    # Nothing changed: no history rows.
    sync_table(table(spark, [(1, "z"), (2, "b")]), store, ["k"], DAYS[3])
    assert Counter(read_history(spark, store).collect()) == Counter(before)


def test_bucketed_compare_shuffles_the_current_side_only(spark, tmp_path):
    store = SnapshotStore(str(tmp_path), Buckets(("k",), 5))
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    sync_table(rows, store, ["k"], DAYS[0])
    sync_table(rows.where("k < 900"), store, ["k"], DAYS[1])
    assert versions(spark, store)[-1] == Version(2, store.buckets.layout)
    files = glob.glob(f"{store.version_path(2, store.buckets.layout)}/*.parquet")
    assert len(files) == 5
    with _aligned(spark, store):
        out = synced_rows(rows.where("k >= 100"), read_snapshot(spark, store), ["k"], DAYS[2])
        assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        assert operations(out) == {"NO_CHANGE": 800, "INSERT": 100, "DELETE": 100}


def test_other_bucket_keys_do_not_count_as_buckets(spark, tmp_path):
    old = SnapshotStore(f"{tmp_path}/it's", Buckets(("k",), 3))
    rows = spark.range(100).selectExpr("id AS k", "id % 7 AS j")
    for day in DAYS[:2]:
        sync_table(rows, old, ["k"], day)
    assert read_snapshot(spark, old).groupBy("k").count().where("count > 1").isEmpty()
    new = SnapshotStore(old.base, Buckets(("j", "k"), 3))
    assert operations(synced_rows(rows, read_snapshot(spark, new), ["j", "k"], DAYS[2])) == {"NO_CHANGE": 100}


def test_unfinished_version_is_ignored(spark, tmp_path):
    store = SnapshotStore(str(tmp_path))
    sync_table(table(spark, [(1, "a")]), store, ["k"], DAYS[0])
    os.makedirs(f"{tmp_path}/v00000002")
    assert versions(spark, store) == [Version(1, "")]
    assert read_snapshot(spark, SnapshotStore(str(tmp_path / "none"))) is None


def test_snapshot_without_key(spark, tmp_path):
    store = SnapshotStore(str(tmp_path))
    for day in DAYS[:2]:
        assert sync_table(table(spark, [(1, "a"), (1, "a")]), store, [], day).counts["snapshot_rows"] == 2
    assert read_history(spark, store) is None


def test_schema_change_in_history(spark, tmp_path):
    store = SnapshotStore(str(tmp_path))
    sync_table(table(spark, [(1, "a")]), store, ["k"], DAYS[0])
    sync_table(table(spark, [(1, "a")]).withColumn("w", F.lit(5)), store, ["k"], DAYS[1])
    got = {r["$_operation"]: r["w"] for r in read_history(spark, store).collect()}
    assert got == {"INSERT": None, "UPDATE": 5}


def test_stored_refresh(spark, tmp_path):
    store = SnapshotStore(str(tmp_path))
    definition = {"type": "aggregation", "select": ["v", "count(*) AS n"], "groupBy": ["v"]}
    assert refresh_table(spark, definition, {"t": table(spark, [(1, "a"), (2, "a"), (3, "b")])}, store, DAYS[0]).version == 1
    assert refresh_table(spark, definition, {"t": table(spark, [(1, "a"), (3, "b")])}, store, DAYS[1]).version == 2
    got = {(r["v"], r["n"], r["$_operation"], str(r["$_last_updated"])) for r in read_snapshot(spark, store).collect()}
    assert got == {("a", 1, "INSERT", DAYS[1]), ("a", 2, "DELETE", DAYS[1]), ("b", 1, "INSERT", DAYS[0])}
    result = refresh_table(spark, definition, {"t": table(spark, [(1, "a"), (3, "b")])}, store, DAYS[2])
    assert result.counts["rows"] == result.counts["insert_rows"] == 2 and result.bytes > 0
    assert operations(read_snapshot(spark, store)) == {"INSERT": 2}


# --- streams ---------------------------------------------------------------------------------------------------------


def test_stream_of_files(spark, tmp_path):
    store, inbox = SnapshotStore(str(tmp_path / "store")), tmp_path / "in"
    arrivals = [[(1, "a"), (2, "b")], [(1, "z")], [(1, "z"), (2, "b")]]
    for i, rows in enumerate(arrivals):
        inbox.mkdir(exist_ok=True)
        (inbox / f"{i}.csv").write_text("k,v\n" + "".join(f"{k},{v}\n" for k, v in rows))
        os.utime(inbox / f"{i}.csv", (1_700_000_000 + i, 1_700_000_000 + i))
    args = dict(schema="k long, v string", keys=["k"], store=store, checkpoint=str(tmp_path / "cp"), fmt="csv")
    stream_sync(spark, str(inbox), clock=lambda batch: DAYS[batch], **args).awaitTermination()
    assert operations(read_snapshot(spark, store)) == {"INSERT": 1, "NO_CHANGE": 1}
    assert operations(read_history(spark, store)) == {"INSERT": 3, "UPDATE": 1, "DELETE": 1}
    # Nothing new: nothing happens.
    stream_sync(spark, str(inbox), clock=lambda batch: DAYS[batch], **args).awaitTermination()
    assert [v.number for v in versions(spark, store)] == [2, 3]


# --- files -----------------------------------------------------------------------------------------------------------


def test_formats():
    names = {"a.csv": "csv", "b.JSON": "json", "/x/y.parquet/": "parquet", "c.txt": "csv", "plain": "csv"}
    assert {n: file_format(n) for n in names} == names


def test_paths():
    assert resolve_path("/in", "/abs//x.csv") == "/abs//x.csv"
    assert resolve_path("/in/", "x.csv") == "/in/x.csv"
    assert resolve_path("s3a://b//in/", "x.csv") == "s3a://b/in/x.csv"
    with pytest.raises(ValueError):
        resolve_path("/in", "")


def test_csv_values(spark, tmp_path):
    (tmp_path / "x.csv").write_text('n,t,d,q,e\n1,2024-01-02 03:04:05,1.5,"a ""b"", c",\n2,,2.5,x,\n')
    df = read_source(spark, str(tmp_path / "x.csv"))
    assert [t for _, t in df.dtypes] == ["bigint", "timestamp_ntz", "double", "string", "string"]
    assert [r["q"] for r in df.orderBy("n").collect()] == ['a "b", c', "x"]
    assert {t for _, t in read_csv(spark, str(tmp_path / "x.csv"), infer=False).dtypes} == {"string"}


def test_json_lines_and_arrays(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"z": 1, "a": "x"}\n{"z": 2, "b": [1], "a": "y"}\n')
    (tmp_path / "array.json").write_text('\n [\n {"z": 1, "a": "x"},\n {"z": 2, "a": "y"}\n]\n')
    lines, array = read_json(spark, str(tmp_path / "lines.json")), read_json(spark, str(tmp_path / "array.json"))
    assert lines.columns == ["a", "b", "z"] and lines.count() == 2
    assert Counter(array.select("z", "a").collect()) == Counter(lines.select("z", "a").collect())


def test_latest_file(spark, tmp_path):
    for name, when in (("a.csv", 300), ("b.csv", 200), ("c.txt", 400)):
        (tmp_path / name).write_text(f"n\n{when}\n")
        os.utime(tmp_path / name, (1_700_000_000 + when,) * 2)
    (tmp_path / "z.csv").mkdir()
    folder = str(tmp_path)
    assert latest_file(spark, folder, "*.csv").first()["name"] == "a.csv"
    assert latest_file(spark, folder, "*.csv", "name").first()["name"] == "b.csv"
    assert latest_file(spark, folder).first()["name"] == "c.txt"
    assert latest_file(spark, folder, "?.parquet").isEmpty()
    assert read_latest(spark, folder, "*.csv").first()["n"] == 300
    with pytest.raises(FileNotFoundError):
        read_latest(spark, folder, "nothing")
    with pytest.raises(ValueError):
        latest_file(spark, folder, strategy="size")


def test_csv_sink(spark, tmp_path):
    df = spark.sql("SELECT 1 AS n, timestamp_ntz '2024-01-02 03:04:05.5' AS t, array(1, 2) AS a, 'x\"y' AS s")
    args = dict(name_template="{model_name}.csv", model_name="m", now=DAYS[0])
    path = write_csv(df, str(tmp_path), **args)
    text = open(glob.glob(f"{path}/*.csv")[0]).read()
    assert text == 'n,t,a,s\n1,2024-01-02 03:04:05.5,"[1,2]","x""y"\n'
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_csv(df, str(tmp_path), **args)
    write_csv(df, str(tmp_path), if_exists="overwrite", **args)
    write_csv(df, str(tmp_path), if_exists="archive", header=False, delimiter="|", **args)
    assert os.listdir(tmp_path / "archive") == ["m.csv.1735689600000.bak"]
    assert open(glob.glob(f"{path}/*.csv")[0]).read().startswith("1|2024")
    with pytest.raises(ValueError):
        write_csv(df, str(tmp_path), if_exists="ignore", **args)


def test_csv_numbers_come_back(spark, tmp_path):
    df = spark.sql("SELECT * FROM VALUES (1, 12345678.9D), (2, 1e-5D), (3, 1e17D), (4, double('nan')), (5, double('-inf')), (6, NULL) AS t(i, d)")
    path = write_csv(df, str(tmp_path), "d.csv")
    text = "".join(open(f).read() for f in glob.glob(f"{path}/*.csv"))
    assert all(t in text for t in ("12345678.9", "1e-05", "1e+17", "nan", "-inf"))
    back = read_csv(spark, path)
    assert dict(back.dtypes)["d"] == "double"
    assert sorted(map(str, back.collect())) == sorted(map(str, df.selectExpr("bigint(i) AS i", "d").collect()))


def test_csv_target_settings(spark, tmp_path):
    config = {"remotePath": str(tmp_path), "fileName": "x.csv"}
    assert export_to_csv(spark.range(3), config, DAYS[0]) == (f"{tmp_path}/x.csv", 3)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        export_to_csv(spark.range(3), config, DAYS[0])
    assert export_to_csv(spark.range(4), config | {"overwriteExisting": True}, DAYS[0])[1] == 4
    export_to_csv(spark.range(5), config | {"archiveAfterUpload": True}, DAYS[0])
    assert len(os.listdir(tmp_path / "archive")) == 1 and read_csv(spark, f"{tmp_path}/x.csv").count() == 5
    assert export_to_csv(spark.range(1), {"remotePath": str(tmp_path)}, DAYS[0])[0].endswith("/export_1735689600000.csv")


def test_partition_extract(spark, tmp_path):
    tables = build_partition({"a b": spark.range(3).selectExpr("'x/y' AS p", "id"), "c": spark.sql("SELECT 'z' AS p")}, "p", "x/y")
    for _ in range(2):
        counts = write_partition(tables, str(tmp_path), "rule", "x/y")
    assert counts == {"a b": 3, "c": 0, "total_rows": 3}
    assert spark.read.parquet(f"{extract_path(str(tmp_path), 'rule', 'x/y', 'a b')}").count() == 3


def test_file_size_bound(spark, tmp_path):
    assert rows_per_file(20) == (10 << 30) // (20 * 1024)
    write_parquet(spark.range(0, 100, 1, 1), str(tmp_path / "p"), max_bytes=30 * 1024)
    assert len(glob.glob(f"{tmp_path}/p/*.parquet")) == 4
    assert spark.read.parquet(str(tmp_path / "p")).count() == 100


def test_jdbc_options():
    assert table_name("t") == "public.t" and table_name("s.t") == "s.t" and table_name("t", None) == "t"
    got = jdbc_options("jdbc:x", query="SELECT 1;", partition=Slices("id", 0, 9, 4))
    assert got["dbtable"] == "(SELECT 1) source_query" and got["numPartitions"] == "4" and got["queryTimeout"] == "3600"
    assert jdbc_options("jdbc:x", "t", default_schema=None)["dbtable"] == "t"
    assert write_options("jdbc:x", "t")["batchsize"] == "1000"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x")


def test_replaced_version_in_the_other_layout(spark, tmp_path):
    plain, bucketed = SnapshotStore(str(tmp_path)), SnapshotStore(str(tmp_path), Buckets(("k",), 2))
    rows = projection.snapshot(table(spark, [(1, "a"), (2, "b")]), now=DAYS[0])
    publish_snapshot(rows, plain, 1)
    publish_snapshot(rows, bucketed, 1, unique=True)
    assert versions(spark, bucketed) == [Version(1, bucketed.buckets.layout)] and read_snapshot(spark, bucketed).count() == 2
    assert cdc.live_rows(read_snapshot(spark, plain)).count() == 2
