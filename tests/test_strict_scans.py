"""Scans of files that do not hold what they should."""

from __future__ import annotations

import pytest

from tidemark.sources.files import read_csv, read_json, read_latest, read_source


def put(folder, **files):
    for name, text in files.items():
        (folder / name.replace("__", ".")).write_text(text)
    return str(folder)


@pytest.mark.parametrize("row", ["2,y,EXTRA", "3"])
@pytest.mark.parametrize("infer", [True, False])
def test_rows_of_other_length(spark, tmp_path, row, infer):
    path = put(tmp_path, a__csv=f"id,v\n1,x\n{row}\n4,z\n")
    for action in (lambda d: d.collect(), lambda d: d.count(), lambda d: d.select("id").collect()):
        with pytest.raises(Exception, match="MALFORMED|FAILED_READ|header|Header"):
            action(read_csv(spark, path, infer=infer))
    good, bad = read_csv(spark, path, infer=infer, bad_rows="aside")
    assert [r[0] for r in good.select("v").collect()] == ["x", "z"] and good.columns == ["id", "v"]
    assert [r["line"] for r in bad.collect()] == [row] and bad.count() == 1 and good.count() == 2
    assert bad.first()["file"].endswith("a.csv")


def test_headers_must_agree(spark, tmp_path):
    path = put(tmp_path, a__csv="id,v\n1,x\n", b__csv="v,id\ny,2\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|header|Header"):
        read_csv(spark, path, infer=False).collect()
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ|header|Header"):
        read_csv(spark, path, schema="id string, v string").collect()
    put(tmp_path, b__csv="id,v\n2,y\n")
    assert sorted(map(tuple, read_csv(spark, path).collect())) == [(1, "x"), (2, "y")]


def test_broken_json_lines(spark, tmp_path):
    path = put(tmp_path, a__json='{"b":1,"a":"x"}\n{"b":2,"a\n{"b":3,"a":"z"}\n')
    for kind in ({}, {"schema": "b long, a string"}):
        for action in (lambda d: d.collect(), lambda d: d.select("b").collect()):
            with pytest.raises(Exception, match="MALFORMED|FAILED_READ|header|Header"):
                action(read_json(spark, path, **kind))
        good, bad = read_json(spark, path, bad_rows="aside", **kind)
        assert sorted(r["b"] for r in good.collect()) == [1, 3] and set(good.columns) == {"a", "b"}
        assert [r["line"] for r in bad.collect()] == ['{"b":2,"a']


def test_json_columns_do_not_follow_file_size(spark, tmp_path):
    path = put(tmp_path, a__json='{"b":1,"a":"x"}\n')
    before = read_json(spark, path).columns
    put(tmp_path, z__json='{"a":"yyyyyyyyyy","c":2,"b":1}\n' * 50)
    assert before == ["a", "b"] and read_json(spark, path).columns == ["a", "b", "c"]
    assert read_json(spark, path, columns=["b", "gone"]).columns == ["b", "a", "c"]


def test_options_reach_the_reader(spark, tmp_path):
    path = put(tmp_path, a__csv="id;v\n1;x\n2\n")
    assert read_source(spark, f"{path}/a.csv", delimiter=";", infer=False, bad_rows="aside")[0].collect() == [("1", "x")]
    assert read_latest(spark, path, delimiter=";", infer=False, bad_rows="aside")[1].count() == 1
    with pytest.raises(ValueError):
        read_csv(spark, path, bad_rows="drop")


def test_latest_takes_finished_folders(spark, tmp_path):
    (tmp_path / "export.csv").mkdir()
    put(tmp_path / "export.csv", part__csv="id\n5\n")
    put(tmp_path, old__csv="id\n1\n")
    assert read_latest(spark, str(tmp_path), "*.csv", "name").first()["id"] == 1
    put(tmp_path / "export.csv", _SUCCESS="")
    (tmp_path / "old.csv").rename(tmp_path / "a.csv")
    assert read_latest(spark, str(tmp_path), "*.csv", "name").first()["id"] == 5
