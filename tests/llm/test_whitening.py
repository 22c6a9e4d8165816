"""Whitening against plain exact sums, and eigenvectors of awkward matrices."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tidemark.llm import whitening
from tidemark.llm.queries import QUERIES

MATRICES = {
    "spread": np.linspace(1, 1000, 40),
    "close": np.concatenate((7 + np.arange(5) * 1e-9, 3 + np.arange(4) * 1e-14, np.linspace(10, 20, 12), np.ones(3))),
    "equal": np.array([5, 5, 5, 2, 2, 1, 1e-12, 0]),
    "wide": 10.0 ** np.linspace(-9, 6, 30),
    "one": np.array([3.0]),
    "nothing": np.zeros(4),
}


@pytest.mark.parametrize("name", MATRICES)
def test_eigenvectors(name):
    values = MATRICES[name].astype(np.longdouble)
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(3).standard_normal((d, d)))[0].astype(np.longdouble)
    for _ in range(4):
        q = q + q @ ((np.eye(d) - q.T @ q) / 2)
    a = (q * values) @ q.T
    found, x = whitening.eigenvectors(a)
    size = max(values.max(), 1e-300)
    assert np.abs(x.T @ x - np.eye(d)).max() < 1e-17
    assert np.abs(a @ x - x * found).max() < 1e-17 * size
    assert np.abs(found - np.sort(values)[::-1]).max() < 1e-17 * size
    apart = [i for i in range(d) if np.abs(np.delete(values, i) - values[i]).min(initial=np.inf) > 1e-6 * size]
    order = {int(k): i for i, k in enumerate(np.argsort(-values, kind="stable"))}
    for i in apart:
        assert 1 - abs(float(q[:, i] @ x[:, order[i]])) < 1e-15


def expected(vectors):
    x = np.array([[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors], dtype=object)
    n, s = len(x), x.sum(axis=0)
    deviation = ((n * x - s) ** 2).sum(axis=1)
    centred = (x - np.array([float(v) / n for v in s])).astype(float)
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    return n, deviation, (centred @ u / np.sqrt(e))[:, ::-1], (e / e.sum())[::-1]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 5, "x") for i, v in rows], "vec_id long, embedding array<float>, n long, component string")


def test_against_plain_sums(spark):
    rng = np.random.default_rng(4)
    scale = np.array([5, 4, 3, 2, 1.5, 1, 0.8, 0.6, 0.4, 0.2])
    vectors = (rng.standard_normal((200, 10)) * scale + 3).astype(np.float32)
    good = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(7, vectors[7].tolist()), (None, vectors[8].tolist())]
    bad = [(900, None), (901, [math.nan] * 10), (902, [math.inf] * 10), (903, [None] + [1.0] * 9), (904, [])]
    got = whitening.whiten(frame(spark, good + bad).repartition(5)).collect()
    n, deviation, white, share = expected([v for _, v in good])
    assert len(got) == 8 * len(good) and {r["n"] for r in got} == {n}
    by_row = {}
    for r in got:
        by_row.setdefault((r["vec_id"], int(r["deviation"])), {})[r["component"]] = r
    signs = {}
    for k, (i, _) in enumerate(good):
        own = by_row[i, deviation[k]]
        assert sorted(own) == list(range(1, 9))
        for c, r in own.items():
            sign = signs.setdefault(c, math.copysign(1, r["whitened"] * white[k, c - 1]))
            assert abs(r["whitened"] - sign * white[k, c - 1]) < 1e-9 and abs(r["explained"] - share[c - 1]) < 1e-12
    assert max(r["identity_error"] for r in got) < 1e-10 and len({r["identity_error"] for r in got}) == 1


def test_awkward_tables(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    one = whitening.whiten(frame(spark, [(1, [0.5, 0.25])])).collect()
    assert [(r["component"], r["whitened"], int(r["deviation"]), r["identity_error"]) for r in one] == [(1, 0.0, 0, 0.0), (2, 0.0, 0, 0.0)]
    line = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(20)])).collect()
    assert max(abs(r["whitened"]) for r in line if r["component"] > 1) == 0 and line[0]["identity_error"] < 1e-9
    mixed = whitening.whiten(frame(spark, [(1, [1.0]), (2, [3.0]), (3, [1.0, 2.0]), (4, [2.0, 2.5]), (5, [0.0, 9.0])])).collect()
    assert {(r["vec_id"], r["n"]) for r in mixed} == {(1, 2), (2, 2), (3, 3), (4, 3), (5, 3)}


def test_large_entries_stay_exact(spark):
    big = [[2.0**40 + i * 2.0**20, -(2.0**45)] for i in range(5)]
    got = whitening.whiten(frame(spark, list(enumerate(big)))).collect()
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in big]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((5 * c - s) ** 2 for c, s in zip(row, sums)) for i, row in enumerate(x)}
    assert {r["vec_id"]: int(r["deviation"]) for r in got} == want
    huge = whitening.whiten(frame(spark, [(1, [3e38]), (2, [-3e38]), (3, [0.0])])).collect()
    assert len(huge) == 3 and all(math.isfinite(r["whitened"]) for r in huge)


def test_the_query(spark):
    got = QUERIES["op13_whitening"](spark, "/root/testdata/sf0.001")
    rows = got.collect()
    assert dict(got.dtypes)["deviation"] == "bigint" and max(r["identity_error"] for r in rows) < 1e-4
    assert len(rows) == 8 * len({r["vec_id"] for r in rows})
