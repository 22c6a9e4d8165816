"""One key holds a third of all rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cdc, keys, merge
from tidemark.plans import extracts
from tidemark.session import overridden


@pytest.fixture()
def skewed(spark):
    settings = {
        "spark__sql__autoBroadcastJoinThreshold": -1,
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "4k",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": 1.2,
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "4k",
    }
    with overridden(spark, **settings):
        rows = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
        )
        yield rows


def final_plan(df):
    rows = df.collect()
    return len(rows), df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_joins_against_keys_split_the_hot_key(skewed):
    n, plan = final_plan(merge.existing_rows(skewed, skewed, ["k"]))
    assert n == 60_000 and "skew=true" in plan
    n, plan = final_plan(merge.missing_rows(skewed, skewed.where("k > 0"), ["k"]))
    assert n == 20_000 and "skew=true" in plan


def test_reconcile_splits_a_hot_target_key(spark, skewed):
    new, _ = merge.reconcile(skewed, spark.range(2).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("v")), ["k"])
    n, plan = final_plan(new)
    assert n == 60_000 and "skew=true" in plan
    assert new.where("v = -1").count() == 20_001


def test_hash_compare_of_a_hot_row(skewed):
    rows = skewed.select("k")
    out = cdc.hash_cdc(rows, cdc.first_refresh(rows.where("k < 100"), "2025-01-01"), "2025-01-02")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # Both joins get plain shuffles on both sides, which is what skew splitting needs.
    assert plan.count("SortMergeJoin") == 2
    for after in plan.split("SortMergeJoin")[1:]:
        sorts = [line for line in after.splitlines() if " Sort " in line or "- Sort" in line]
        lines = after.splitlines()
        for sort in sorts[:2]:
            assert "Exchange hashpartitioning" in lines[lines.index(sort) + 1]
    assert out.count() == 60_000


def test_dedup_sends_one_row_per_key_and_task(skewed):
    out = keys.dedup_by_key(skewed, ["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert out.count() == 40_001


def test_hot_partition_value_is_written_by_several_tasks(spark, skewed, tmp_path):
    rows = skewed.select((F.col("k") == 0).alias("hot"), "v")
    extracts.build_all_partitions({"t": rows}, "hot", str(tmp_path), "p")
    back = extracts.read_extracts(spark, str(tmp_path), "p", "t")
    assert back.count() == 60_000
    assert back.where("hot").select(F.input_file_name()).distinct().count() > 1
