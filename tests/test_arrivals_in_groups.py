"""An arriving file can be read by more than one task."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq

from registry import spark_queries


def test_an_arriving_file_has_several_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spark_queries, "ARRIVED_GROUP_BYTES", 64 << 10)
    spark_queries.write_arrival(spark.range(60_000).selectExpr("id", "uuid() AS text"), str(tmp_path / "in"))
    (file,) = Path(tmp_path / "in").glob("*.parquet")
    assert pq.ParquetFile(file).num_row_groups > 4
