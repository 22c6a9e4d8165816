"""Connected components by alternating large-star and small-star steps, all as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

PART_EDGES = 20_000  # edges that a task takes at least


def in_few_tasks(rows: DataFrame, least: int) -> tuple[DataFrame, int]:
    """``rows`` materialized, in as many tasks as they are worth at ``least`` rows each, and that number of tasks.

    The driver keeps an account of every task, so steps over few rows are not to take one per shuffle partition.
    """
    seen = Observation()
    kept = cut_lineage(rows.observe(seen, F.count("*").alias("rows")))
    tasks = max(1, -(-seen.get["rows"] // least))
    return kept.coalesce(tasks), tasks


def _round_in_one_task(both: DataFrame) -> DataFrame:
    """What a round makes of the edges in both directions. Windows, as Spark would shuffle for a join even within one partition."""
    star = Window.partitionBy("u")
    large = both.withColumn("m", F.least("u", F.min("v").over(star))).where(F.col("v") > F.col("u"))
    hung = large.select(F.col("v").alias("u"), F.col("m").alias("v")).withColumn("m", F.min("v").over(star))
    ends = F.array(*[F.struct(F.col(c).alias("u"), F.col("m").alias("v")) for c in ("u", "v")])
    return hung.select(F.inline(ends)).where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns ``a, b``); the component is its smallest node.

    Loops and NULL ends are left out, repeated edges count once; no edges give no rows. Each round hangs neighbours below
    their smallest neighbour, so that the number of rounds grows with the logarithm of the longest path; the rounds end when
    no node with a smaller neighbour has any other. What reaches the driver is at most one such node per round.

    A round takes as many tasks as its edges are worth, ``PART_EDGES`` each, however many shuffle partitions there are: each
    task leaves three files per shuffle, and rounds over few edges would leave little else. Edges never become more. Those of
    one task need no shuffle at all.
    """
    ends = edges.where(F.col("a") != F.col("b"))
    stars, tasks = in_few_tasks(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), PART_EDGES)
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if tasks == 1:
            both = both.coalesce(1)
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        if least.where((F.col("m") < F.col("u")) & (F.col("n") > 1)).isEmpty():
            break
        if tasks == 1:
            stars = cut_lineage(_round_in_one_task(both).coalesce(1))
            continue
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.coalesce(tasks)
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(lowest, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionByName(lowest.select("u", F.col("m").alias("v"))).coalesce(tasks)
        stars = cut_lineage(moved.distinct().coalesce(tasks))
    stars = stars.coalesce(tasks)
    roots = stars.select(F.col("v").alias("node")).distinct().coalesce(tasks).withColumn("component", F.col("node"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
