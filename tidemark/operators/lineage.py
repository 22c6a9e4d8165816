"""Which derived models depend on a model, and in what order to refresh them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, staging
from .keys import likely_among


def dependents(models: DataFrame, model_id: str) -> DataFrame:
    """Derived models that name ``model_id`` among their sources."""
    return models.where((F.col("model_kind") == "derived") & F.array_contains("source_models", model_id))


def dependency_edges(models: DataFrame) -> DataFrame:
    """One row (source, id) per source of a derived model."""
    derived = models.where(F.col("model_kind") == "derived")
    return derived.select(F.explode(F.array_distinct("source_models")).alias("source"), "id")


def refresh_order(models: DataFrame, model_id: str) -> DataFrame:
    """Every model reached from ``model_id`` with the round (``level``) in which to refresh it.

    A model comes after all of its sources that are refreshed as well. Models on a cycle make this an error that names them.

    The models at the end of paths of one step, two steps and so on are found round by round; the last round that finds a model is
    its level. If that does not end within ``SHALLOW`` rounds, stretches of models with one source are jumped over: such a
    model is one round after its source, so by pointer doubling, in the logarithm of the stretch's length, each points at the
    nearest one above that has several sources (a meet), or none, or is the root. Between those meets two loops run over what is
    left of the depth: the first finds what is reached, the second keeps the number of sources that each still waits for. A round
    is one write into a folder that is removed at the end.
    """
    spark = models.sparkSession
    with staging(spark) as stage:
        edges = stage(dependency_edges(models))
        root = spark.range(1).select(F.lit(model_id).alias("id"))
        ends, paths = root, []
        while len(paths) < SHALLOW:
            # Spark would shuffle all edges in each round; most lead from models that the round does not reach.
            ends = stage(likely_among(edges, "source", ends).join(_as_source(ends), "source").select("id").distinct())
            paths.append(ends.withColumn("level", F.lit(len(paths) + 1)))
            if ends.isEmpty():
                return cut_lineage(_joined(paths).groupBy("id").agg(F.max("level").alias("level")))
        degree = edges.groupBy("id").agg(F.count("*").alias("sources"), F.min("source").alias("one"))
        degree = stage(degree)
        single = (F.col("sources") == 1) & (F.col("id") != model_id)
        pointers = _jumped(stage, degree.where(single).select("id", F.col("one").alias("above"), F.lit(1).alias("steps")))
        meets = degree.where(~single).select("id")

        # Edges into meets, from the meet (or end) above each source; of several between two the longest counts.
        into = edges.join(meets, "id", "left_semi").join(_as_source(pointers, "above", "steps"), "source", "left")
        above, steps = F.coalesce("above", "source").alias("source"), (F.coalesce("steps", F.lit(0)) + 1).alias("steps")
        links = stage(into.select(above, "id", steps).groupBy("source", "id").agg(F.max("steps").alias("steps")))

        rounds, frontier = [stage(root)], root
        while True:
            step = links.join(_as_source(frontier), "source").select("id").distinct()
            frontier = stage(step.join(_joined(rounds), "id", "left_anti"))
            if frontier.isEmpty():
                break
            rounds.append(frontier)
        reached = _joined(rounds)
        inner = stage(links.join(_as_source(reached), "source", "left_semi"))
        if not inner.where(F.col("id") == model_id).isEmpty():
            raise ValueError(_cycle_message(stage, edges, inner, pointers, f"through {model_id!r}"))

        waits = inner.groupBy("id").agg(F.count("*").alias("open"), F.lit(0).alias("level"))
        first = waits.unionByName(root.select("id", F.lit(0).cast("long").alias("open"), F.lit(0).alias("level")))
        state = stage(first.withColumn("round", F.when(F.col("open") == 0, 0)))
        number = 0
        while True:
            ready = state.where(F.col("round") == number)
            if ready.isEmpty():
                break
            number += 1
            done = ready.select(F.col("id").alias("source"), F.col("level").alias("from"))
            less = inner.join(done, "source").groupBy("id")
            less = less.agg(F.count("*").alias("less"), F.max(F.col("from") + F.col("steps")).alias("least"))
            still = F.col("open") - F.coalesce("less", F.lit(0))
            state = state.join(less, "id", "left").select(
                "id",
                still.alias("open"),
                F.greatest("level", F.coalesce("least", F.lit(0))).alias("level"),
                F.coalesce("round", F.when(still == 0, number)).alias("round"),
            )
            state = stage(state)
        stuck = state.where("round IS NULL").select("id")
        if not stuck.isEmpty():
            among = inner.join(stuck, "id", "left_semi").join(_as_source(stuck), "source", "left_semi")
            raise ValueError(_cycle_message(stage, edges, among, pointers, f"below {model_id!r}"))
        known = state.select(F.col("id").alias("above"), "level")
        below = pointers.join(known, "above").select("id", (F.col("level") + F.col("steps")).alias("level"))
        found = state.where(F.col("id") != model_id).select("id", "level").unionByName(below)
        return cut_lineage(found.select("id", F.col("level").cast("int").alias("level")))


SHALLOW = 8  # rounds before stretches are jumped over
NAMED = 20  # members of a cycle that an error names


def _jumped(stage, pointers: DataFrame) -> DataFrame:
    """``id, above, steps`` with every pointer moved up to where pointers end.

    Each round doubles the steps of the pointers that have not ended. Models that never get to an end, those on or below a cycle of
    nothing but single sources, are left out: nothing else leads there.
    """
    held, ended = pointers, []
    before = None
    while True:
        onward = held.select(F.col("id").alias("above"), F.col("above").alias("next"), F.col("steps").alias("more"))
        ends = F.col("next").isNull()
        moved = held.join(onward, "above", "left")
        if ended:
            done = _joined(ended).select(F.col("id").alias("above"), F.col("above").alias("end"), F.col("steps").alias("last"))
            moved = moved.join(done, "above", "left")
            ends = ends & F.col("end").isNull()
            up, far = F.coalesce("next", "end", "above"), F.coalesce("more", "last", F.lit(0))
            over = F.col("next").isNull()
        else:
            up, far, over = F.coalesce("next", "above"), F.coalesce("more", F.lit(0)), ends
        moved = stage(moved.select("id", up.alias("above"), (F.col("steps") + far).alias("steps"), over.alias("over")))
        ended.append(moved.where("over").drop("over"))
        held = moved.where("NOT over").drop("over")
        left = held.count()
        if left in (0, before):
            return reduce(DataFrame.unionByName, ended)
        before = left


def _cycle_message(stage, edges: DataFrame, links: DataFrame, pointers: DataFrame, where: str) -> str:
    """What to say of a cycle among ``links``, with the models on it.

    Meets that nothing in the rest leads to or from are trimmed away, then one meet's forward and backward reach are cut: that
    is its cycle. The models on the way between its meets come from the edges.
    """
    rest = stage(links.select("source", "id"))
    while True:
        less = rest.join(rest.select(F.col("source").alias("id")).distinct(), "id", "left_semi")
        less = stage(less.join(_as_source(rest.select("id").distinct()), "source", "left_semi"))
        if less.count() in (0, rest.count()):
            rest = less
            break
        rest = less
    pivot = rest.agg(F.min("id")).first()[0]

    def reach(here: str, there: str) -> DataFrame:
        frontier = stage(rest.sparkSession.range(1).select(F.lit(pivot).alias("id")))
        rounds = [frontier]
        while True:
            step = rest.join(frontier.select(F.col("id").alias(here)), here).select(F.col(there).alias("id")).distinct()
            frontier = stage(step.join(_joined(rounds), "id", "left_anti"))
            if frontier.isEmpty():
                return _joined(rounds)
            rounds.append(frontier)

    members = stage(reach("source", "id").join(reach("id", "source"), "id", "left_semi"))
    # Between two meets of the cycle: models that point at one of them and lead, by single steps, into another.
    between = pointers.join(members.select(F.col("id").alias("above")), "above", "left_semi").select("id", "steps")
    into = edges.join(members, "id", "left_semi").select(F.col("source").alias("id")).distinct()
    tails = stage(between.join(into, "id", "left_semi").select("id"))
    found, way = [members], tails
    while not way.isEmpty():
        found.append(way)
        up = edges.join(way, "id", "left_semi").select(F.col("source").alias("id")).distinct()
        up = up.join(between, "id", "left_semi").select("id")
        way = stage(up.join(reduce(DataFrame.unionByName, found), "id", "left_anti"))
        if len(found) > NAMED:
            break
    every = reduce(DataFrame.unionByName, found).distinct()
    names = [r["id"] for r in every.orderBy("id").limit(NAMED + 1).collect()]
    told = ", ".join(map(repr, names[:NAMED])) + (" and more" if len(names) > NAMED else "")
    return f"models depend on each other in a cycle {where}: {told}"


def _joined(frames: list[DataFrame]) -> DataFrame:
    """All staged rounds as one."""
    return reduce(DataFrame.unionByName, frames)


def _as_source(ids: DataFrame, *others: str) -> DataFrame:
    return ids.select(F.col("id").alias("source"), *others)
