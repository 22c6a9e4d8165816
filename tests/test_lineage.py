"""Refresh order of deep and of cyclic model graphs, against a plain walk."""

from __future__ import annotations

import random

import pytest

from tidemark.operators import lineage

SCHEMA = "id string, model_kind string, source_models array<string>"


def frame(spark, sources):
    rows = [(m, "derived" if s else "base", s) for m, s in sources.items()]
    return spark.createDataFrame(rows, SCHEMA)


def plain(sources, root):
    """Levels by walking models in the order they are given, sources first."""
    level = {root: 0}
    for model, above in sources.items():
        known = [level[s] + 1 for s in above if s in level]
        if known and model != root:
            level[model] = max(known)
    return {m: v for m, v in level.items() if m != root}


def test_a_deep_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    kept = lineage.staging

    def counted(session):
        manager = kept(session)
        inner = manager.__enter__()
        manager.__enter__ = lambda: None

        class Block:
            def __enter__(self):
                return lambda df: rounds.append(1) or inner(df)

            def __exit__(self, *told):
                return manager.__exit__(*told)

        return Block()

    monkeypatch.setattr(lineage, "staging", counted)
    chain = {"m0": []} | {f"m{i}": [f"m{i - 1}"] for i in range(1, 1001)}
    got = dict(map(tuple, lineage.refresh_order(frame(spark, chain), "m0").collect()))
    assert got == {f"m{i}": i for i in range(1, 1001)}
    assert len(rounds) <= 30  # 25 rounds, and the copies of the edges


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("shallow", [0, 8])
def test_random_graphs(spark, monkeypatch, seed, shallow):
    monkeypatch.setattr(lineage, "SHALLOW", shallow)
    rnd, n = random.Random(seed), 30
    graph = {"n0": []} | {f"n{i}": sorted({f"n{rnd.randrange(i)}" for _ in range(rnd.choice([1, 1, 2, 3]))}) for i in range(1, n)}
    got = dict(map(tuple, lineage.refresh_order(frame(spark, graph), "n4").collect()))
    assert got == plain(graph, "n4")


@pytest.mark.parametrize("shallow", [0, 8])
def test_cycles_name_their_members(spark, monkeypatch, shallow):
    monkeypatch.setattr(lineage, "SHALLOW", shallow)
    below = {"a": [], "b": ["a", "e"], "c": ["b"], "d": ["c"], "e": ["d"], "tail": ["e"], "last": ["tail", "a"], "side": ["a"]}
    with pytest.raises(ValueError, match=r"cycle below 'a': 'b', 'c', 'd', 'e'$"):
        lineage.refresh_order(frame(spark, below), "a")
    through = {"a": ["c"], "b": ["a"], "c": ["b"], "x": ["c"]}
    with pytest.raises(ValueError, match=r"cycle through 'a': 'a', 'b', 'c'$"):
        lineage.refresh_order(frame(spark, through), "a")
    apart = {"a": [], "b": ["a"], "p": ["q"], "q": ["p"], "r": ["q"]}
    assert lineage.refresh_order(frame(spark, apart), "a").collect() == [("b", 1)]
