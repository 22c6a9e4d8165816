from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import types as T

from tidemark.operators import changelog, export, lineage, merge, models, partitions, projection
from tidemark.plans import outbound
from tidemark.plans.outbound import WritePlan, run_plan, write_plan

NOW = "2025-01-02 00:00:00"


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "old", 10), (2, "old", 20)], "k int, v string, own int")


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame([(2, "new", True), (3, "new", True), (3, "other", True), (None, "n", True)], "k int, v string, x boolean")


def test_upsert_keeps_columns_of_the_target(target, source):
    got = {tuple(r) for r in merge.upsert(target, source.where("v <> 'other'"), ["k"]).collect()}
    assert got == {(1, "old", 10), (2, "new", 20), (3, "new", None), (None, "n", None)}


def test_upsert_of_keys_alone_ignores_known_ones(spark, target):
    got = merge.upsert(target.select("k"), spark.createDataFrame([(2,), (4,), (4,)], "k int"), ["k"])
    assert rows_of(got) == {(1,): 1, (2,): 1, (4,): 1}


@pytest.mark.parametrize("unique", [True, False])
def test_reconcile(target, source, unique):
    new, changes = merge.reconcile(target, source.where("v <> 'other'"), ["k"], unique_target=unique)
    assert rows_of(new) == {(1, "old", 10): 1, (2, "new", 20): 1, (3, "new", None): 1, (None, "n", None): 1}
    assert Counter(r["__change"] for r in changes.collect()) == {"INSERT": 2, "UPDATE": 1}


def test_reconcile_twice_is_the_same(target, source):
    keyed = source.where("k IS NOT NULL")
    once, _ = merge.reconcile(target, keyed, ["k"])
    twice, changes = merge.reconcile(once, keyed, ["k"], changed_only=True)
    assert rows_of(once) == rows_of(twice) and changes.isEmpty()


def test_reconcile_updates_every_repeat_of_a_target_key(spark, source):
    target = spark.createDataFrame([(2, "a", i) for i in range(5)], "k int, v string, own int")
    new, _ = merge.reconcile(target, source.where("k = 2"), ["k"])
    assert rows_of(new) == {(2, "new", i): 1 for i in range(5)}


PLANS = [
    ({}, "postgres", WritePlan("append"), "INSERT"),
    ({"truncateFirst": True}, "mysql", WritePlan("append", (), True), "INSERT"),
    ({"upsertMode": True}, "postgres", WritePlan("append"), "INSERT"),
    ({"primaryKey": ["k"]}, "postgres", WritePlan("upsert", ("k",)), "UPSERT"),
    ({"upsertKeys": ["k"], "truncateFirst": True}, "postgres", WritePlan("upsert", ("k",), True), "UPSERT"),
    ({"primaryKey": ["k"], "upsertKeys": ["v"]}, "mysql", WritePlan("reconcile", ("k",)), None),
    ({"primaryKey": ["k"], "truncateFirst": True}, "mysql", WritePlan("reload", ("k",), True), "TRUNCATE_RELOAD"),
]


@pytest.mark.parametrize("config,kind,plan,operation", PLANS)
def test_write_plans(target, source, config, kind, plan, operation):
    assert write_plan(config, kind) == plan and plan.operation == operation
    result = run_plan(plan, target, source, NOW, "j")
    logged = Counter(r["$_changelog_operation"] for r in result.changelog.collect())
    n_target, n_source, n_keys = 2, 4, 3
    expected = {
        ("append", False): (n_target + n_source, {"INSERT": n_source}),
        ("append", True): (n_source, {"INSERT": n_source}),
        ("upsert", False): (n_target + 2, {"UPSERT": n_keys}),
        ("upsert", True): (n_keys, {"UPSERT": n_keys}),
        ("reconcile", False): (n_target + 2, {"INSERT": 2, "UPDATE": 1}),
        ("reload", True): (n_keys, {"TRUNCATE_RELOAD": n_keys}),
    }[plan.action, plan.clear_first]
    assert (result.target.count(), logged) == expected
    assert result.target.columns == target.columns


def test_plan_for_a_new_table(source):
    result = run_plan(write_plan({"primaryKey": ["k"]}, "postgres"), None, source, NOW)
    assert result.target.count() == 3 and result.target.columns == source.columns


@pytest.mark.parametrize("keys,kind", [([], "postgres"), (["k"], "postgres"), (["k"], "mysql")])
def test_export_to_a_database(spark, target, source, tmp_path, monkeypatch, keys, kind):
    sent = {}
    monkeypatch.setattr(outbound, "append_jdbc", lambda df, options: sent.update(appended=df.collect()))
    monkeypatch.setattr(outbound, "replace_jdbc", lambda df, options: sent.update(replaced=df.collect()))
    snapshot = projection.tag_snapshot(source, NOW)
    plan = write_plan({"primaryKey": keys}, kind)
    schema = T.StructType([T.StructField("K", T.IntegerType(), False), T.StructField("V", T.StringType(), False)])
    path = str(tmp_path / "log")
    for _ in range(2):
        outbound.export_to_jdbc(snapshot, {}, plan, NOW, "j", target, schema, path)
    rows = sent.get("appended") or sent.get("replaced")
    assert set(sent) == ({"replaced"} if keys else {"appended"})
    assert len(rows) == 4 and (0, "n") in {(r["k"], r["v"]) for r in rows}
    assert outbound.read_changelog(spark, path).count() == (3 if keys else 4)


def test_unknown_target():
    with pytest.raises(ValueError):
        write_plan({}, "oracle")


def test_changelog_columns(source):
    row = changelog.build_changelog(projection.tag_snapshot(source, NOW), NOW, None, "INSERT").first().asDict()
    assert {k: v for k, v in row.items() if k.startswith("$_")} == {
        "$_changelog_operation": "INSERT",
        "$_changelog_timestamp": "2025-01-02T00:00:00.000Z",
        "$_changelog_job_id": "unknown",
        "$_changelog_row_type": "new",
    }


def test_changelog_takes_later_columns(source):
    old = changelog.build_changelog(source.drop("x"), NOW, "a", "INSERT")
    merged = changelog.merge_changelog(old, changelog.build_changelog(source, NOW, "b", "INSERT"))
    assert merged.count() == 8 and "x" in merged.columns


def test_boolean_and_nested_columns_are_not_filled(spark):
    df = spark.sql("SELECT CAST(NULL AS boolean) AS b, CAST(NULL AS decimal(9,2)) AS d, array(1) AS a, CAST(NULL AS string) AS s")
    schema = T.StructType([T.StructField(f.name, f.dataType, False) for f in df.schema.fields])
    row = export.prepare_export(df, schema).first()
    assert row["b"] is None and row["d"] == 0 and row["a"] == [1] and row["s"] == ""


def test_export_without_tombstones(spark):
    df = projection.tag_snapshot(spark.range(3), NOW).replace("SNAPSHOT", "DELETE", subset=["`$_operation`"])
    assert export.prepare_export(df, live_only=True).isEmpty() and export.prepare_export(df).count() == 3


# --- partitions ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "column,value,ids",
    [
        ("n", "7", [1]), ("n", "7.0", [1]), ("n", "7.5", []), ("n", "99999999999999999999", []), ("n", "7e0", [1]),
        ("s", "007", [1, 2]), ("s", "7", [1, 2]), ("s", "O'Brien", [3]), ("s", "", [4]), ("d", "1.5", [2]),
        ("p", "1.25", [1]), ("p", "1.251", []), ("b", "1", [1]), ("day", "2024-01-02", [1]),
    ],
)
def test_partition_values(spark, column, value, ids):
    df = spark.sql("""
        SELECT * FROM VALUES
          (1, 7L, '7', 0.5D, CAST(1.25 AS decimal(9,2)), true, date '2024-01-02'),
          (2, 8L, '007', 1.5D, CAST(2 AS decimal(9,2)), false, date '2024-01-03'),
          (3, 9L, 'O''Brien', 2.5D, CAST(3 AS decimal(9,2)), false, NULL),
          (4, NULL, '', NULL, NULL, NULL, NULL) AS t(id, n, s, d, p, b, day)""")
    got = partitions.partition_filter(df, column, value)
    assert sorted(r["id"] for r in got.collect()) == ids


def test_partition_of_nothing(spark):
    with pytest.raises(ValueError):
        partitions.build_partition({"a": None}, "n", "7")


def test_partition_filter_reaches_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    plan = partitions.partition_filter(df, "c_nationkey", "7")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(c_nationkey,7)" in plan


# --- models ----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "definition",
    [
        None,
        {},
        {"type": "pivot"},
        {"type": "custom"},
        {"type": "join", "joins": [{"type": "INNER", "on": "true"}]},
        {"type": "join", "joins": [{"type": "INNER", "table": "b", "on": ["x"]}]},
        {"type": "join", "joins": [{"type": "CROSS", "table": "b", "on": "true"}]},
    ],
)
def test_bad_definitions(spark, definition):
    with pytest.raises(ValueError):
        models.build_model(spark, definition, {"a": spark.range(1), "b": spark.range(1)})


def test_no_sources(spark):
    with pytest.raises(ValueError):
        models.build_model(spark, {"type": "filter"}, {})


def test_join_target_names():
    assert models.resolve_model("Users", ["users", "users_old"]) == "users"
    assert models.resolve_model("Users", ["x_users_model", "orders"]) == "x_users_model"
    assert models.resolve_model("nothing", ["a1", "b1"]) == "nothing"
    with pytest.raises(ValueError):
        models.resolve_model("users", ["users_a", "users_b"])


def test_star_of_snapshots_has_no_system_columns_and_unique_names(spark):
    a = projection.tag_snapshot(spark.createDataFrame([(1, "x")], "id int, v string"), NOW)
    b = projection.tag_snapshot(spark.createDataFrame([(1, "y")], "id int, v string"), NOW)
    definition = {"type": "join", "joins": [{"type": "left", "table": "Model B", "on": ["id", "id"]}], "where": "`a`.`$_operation` = 'SNAPSHOT'"}
    out = models.build_model(spark, definition, {"a": a, "model-b": b})
    assert out.columns == ["id", "v", "id_1", "v_1"] and tuple(out.first()) == (1, "x", 1, "y")


def test_double_quoted_identifiers(spark):
    a = projection.tag_snapshot(spark.range(2), NOW)
    definition = {"type": "filter", "select": ['"id" AS "Row Id"'], "where": "\"$_operation\" <> 'DELETE'"}
    out = models.build_model(spark, definition, {"a": a}, double_quoted_identifiers=True)
    assert out.columns == ["Row Id"] and out.count() == 2
    assert spark.sql('SELECT "text" AS t').first()[0] == "text"


def test_order_by(spark):
    out = models.build_model(spark, {"type": "filter", "orderBy": ["id DESC"]}, {"a": spark.range(5)})
    assert [r[0] for r in out.collect()] == [4, 3, 2, 1, 0]


# --- lineage ---------------------------------------------------------------------------------------------------------


def graph(spark, edges):
    rows = [(m, "derived" if s else "base", s) for m, s in edges.items()]
    return spark.createDataFrame(rows, "id string, model_kind string, source_models array<string>")


def test_refresh_order(spark):
    df = graph(spark, {"a": [], "b": [], "c": ["a"], "d": ["a", "b"], "e": ["c", "d"], "f": ["e", "a", "a"], "g": ["b"]})
    assert {r["id"] for r in lineage.dependents(df, "a").collect()} == {"c", "d", "f"}
    assert {tuple(r) for r in lineage.refresh_order(df, "a").collect()} == {("c", 1), ("d", 1), ("e", 2), ("f", 3)}
    assert lineage.refresh_order(df, "g").isEmpty()


@pytest.mark.parametrize("edges", [{"c": ["a", "d"], "d": ["c"]}, {"a": ["c"], "c": ["a"]}])
def test_cycles_raise(spark, edges):
    with pytest.raises(ValueError):
        lineage.refresh_order(graph(spark, {"a": [], **edges}), "a")


def test_cycle_elsewhere_does_not_matter(spark):
    df = graph(spark, {"a": [], "b": ["a"], "x": ["y"], "y": ["x"]})
    assert {tuple(r) for r in lineage.refresh_order(df, "a").collect()} == {("b", 1)}


# --- projection ------------------------------------------------------------------------------------------------------


def test_projection_choice(spark):
    df = spark.createDataFrame([("1", "0000-00-00", "x")], "A string, d string, z string")
    schema = [{"name": "a", "type": "int"}, {"name": "d", "type": "date"}]
    assert projection.project(df).columns == ["A", "d", "z"]
    assert tuple(projection.project(df, schema=schema).first()) == (1, None)
    mapped = projection.project(df, [{"source": "A", "target": "N"}], [{"name": "n", "type": "int"}])
    assert mapped.columns == ["N"] and mapped.first()[0] == 1
    exact = projection.project(df, [{"source": "A", "target": "N"}], [{"name": "n", "type": "int"}], exact=True)
    assert exact.first()[0] == "1"


def test_mappings_from_nested_schema():
    schema = [{"name": "g", "children": [{"name": "t", "sourceColumn": "s"}, {"name": "u"}]}, {"name": "h"}]
    assert projection.mappings_from_schema(schema) == [{"source": "s", "target": "t"}]
    assert projection.mappings_from_schema(schema[0]) == [{"source": "s", "target": "t"}]
