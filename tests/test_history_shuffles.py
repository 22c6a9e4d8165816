"""Rows of a history of any origin are made distinct in one shuffle."""

from __future__ import annotations

from tidemark.operators import history, projection


def test_a_history_of_any_origin_is_shuffled_once(spark):
    rows = projection.snapshot(spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k long, v string"), now="2025-01-01")
    old = history.history_changes(rows, "2025-01-01", unique_rows=True)
    out = history.append_history(rows, old, "2025-01-02")
    assert out.count() == 4
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
