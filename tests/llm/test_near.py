"""Near duplicates of texts and vectors, fingerprints: against brute force, and on awkward rows."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tidemark.llm import fingerprints, graph, minhash, vectors
from tidemark.llm.graph import components
from tidemark.session import cut_lineage, overridden


def roots(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return [find(i) for i in range(n)]


def word_sets(text, width):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in low).split(" ") if w]
    if not words:
        return set()
    width = min(width, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(texts, width, percent=80):
    sets = [word_sets(t, width) for t in texts]
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    return [len(s) for s in sets], roots(len(sets), links)


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [None, "", " \t\n", "one", "ONE", "one two", "Ünï code x", "x" * 50_000]
    while len(texts) < n:
        words = rng.choices(vocabulary, k=rng.randint(1, 120))
        texts.append(" ".join(words))
        for _ in range(rng.randint(0, 4)):
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(rng.choice([" ", "\n"]).join(words))
    return texts


@pytest.mark.parametrize("width", [2, 5])
def test_minhash_equals_brute_force(spark, docs, width):
    texts = corpus(width)
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs(*texts), width).collect()}
    sizes, comps = brute(texts, width)
    assert [got[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert [got[i]["component_id"] for i in range(len(texts))] == comps
    assert all(got[i]["kept"] == (comps[i] == i) for i in got)


def test_minhash_blocks_of_a_large_bucket(spark, docs, monkeypatch):
    """Near copies that only hang together through others, in buckets of several blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(100)]
    texts = []
    for _ in range(60):
        words = list(words)
        words[rng.randrange(100)] = f"v{rng.random()}"
        texts.append(" ".join(words))
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs(*texts), 2).collect()}
    assert [got[i] for i in range(60)] == brute(texts, 2)[1]


def families(seed, n=240):
    """Families of texts that share much of a base text: of similarities from far below the limit to above it."""
    rng = random.Random(seed)
    texts = []
    for f in range(3):
        base = [f"f{f}w{i}" for i in range(90)]
        for _ in range(n // 3):
            words = list(base)
            for _ in range(rng.choice([1, 3, 6, 9, 12])):
                words[rng.randrange(90)] = f"v{rng.randrange(10**9)}"
            texts.append(" ".join(words))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("block", "hot", "fine"), [(1024, 10**6, 1024), (8, 10**6, 1024), (8, 16, 1024), (8, 16, 40), (1024, 10**6, 40)])
def test_minhash_in_open_buckets_equals_brute_force(spark, docs, monkeypatch, block, hot, fine):
    """Buckets of several components: in one block, in several, split by a second band, and with sets that are not whole."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "HOT", hot)
    monkeypatch.setattr(minhash, "FINE", fine)
    texts = families(31)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs(*texts), 2).collect()}
    want = brute(texts, 2)[1]
    assert [got[i] for i in range(len(texts))] == want
    assert len(set(want)) > 50


def test_meeting_rows_grow_with_the_bucket(spark, monkeypatch):
    """Unlike classes of one hot bucket part in the second band, so that their rows do not grow with its square."""
    monkeypatch.setattr(minhash, "HOT", 16)
    made = []
    for n in (200, 800):
        rows = [(i, i, [7, *(1000 * b + i for b in range(1, minhash.BANDS))]) for i in range(n)]
        own = spark.createDataFrame(rows, "id long, s1 long, bands array<long>")
        placed = own.selectExpr("7L AS bucket", "0 AS band", "id", "s1", "id AS component")
        dealt = minhash.open_meets(minhash._by_second_band(minhash.mixed_buckets(placed), own), 8)
        made.append(dealt.count())
    assert made == [0, 0]  # no two share another band


def test_a_bucket_of_one_block_costs_a_row_per_class(spark):
    placed = spark.range(50).selectExpr("7L AS bucket", "0 AS band", "id", "id AS s1", "id DIV 2 AS component")
    dealt = minhash.open_meets(minhash.mixed_buckets(placed), 64)
    rows = dealt.collect()
    assert len(rows) == 50 and all(r["stays"] for r in rows) and sum(r["visits"] for r in rows) == 48
    several = [(r["id"], r["block"], r["group"], r["stays"], r["visits"]) for r in minhash.open_meets(minhash.mixed_buckets(placed), 16).collect()]
    stays = {(i, b, g) for i, b, g, s, _ in several if s}
    visits = {(i, b, g) for i, b, g, _, v in several if v}
    assert len(several) == len({x[:3] for x in several})  # no class twice in a meeting
    ids = {i for i, _, _ in visits}
    assert all({i for i, b, g in stays if (b, g) in {(b, g) for k, b, g in visits if k == j}} == set(range(50)) for j in ids)


def test_two_texts_under_an_id_have_their_own_sketches(spark, docs):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    near = [" ".join(f"{c}{i}" for i in range(58)) for c in "ab"]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs((1, a), (1, b), (2, near[0]), (3, near[1])), 2).collect()}
    assert got == {1: 1, 2: 1, 3: 1}


def test_minhash_on_awkward_rows(spark, docs):
    assert minhash.near_duplicates(docs(), 2).collect() == []
    same = "a b c d e f g"
    frame = docs((7, same), (7, same), (3, same), (None, same), (9, None), (9, "p q r s t"), (2, "p q r s t"))
    rows = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["component_id"], r["kept"]) for r in minhash.near_duplicates(frame, 2).collect())
    assert rows == [
        (False, 2, 2, True), (False, 3, 3, True), (False, 7, 3, False), (False, 7, 3, False), (False, 9, 2, False), (False, 9, 9, True),
        (True, 0, None, True),
    ]


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(3)
    for size in (1, 2, 30, 5000):
        assert (minhash.sketch(rng.integers(0, 2**64, size, dtype=np.uint64)) != 2**64 - 1).all()
    a = rng.integers(0, 2**64, 1000, dtype=np.uint64)
    b = np.concatenate((a[:900], rng.integers(0, 2**64, 100, dtype=np.uint64)))
    same = np.mean(minhash.sketch(a) == minhash.sketch(b))
    assert abs(same - 900 / 1100) < 0.08


def test_long_texts_are_cut_at_white_space(monkeypatch):
    text = "alpha beta\tgamma " * 500
    whole = minhash.words(text)
    monkeypatch.setattr(minhash, "SEGMENT", 64)
    assert (minhash.words(text) == whole).all()


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 130)] + [(7, 7), (60, 61), (61, 60)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**dict.fromkeys(range(51), 0), **dict.fromkeys(range(100, 130), 100), 60: 60, 61: 60}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rng = np.random.default_rng(9)
    x = rng.standard_normal((300, 24))
    for i in range(100, 300):  # neighbours at all sorts of angles, around the threshold too
        x[i] = x[i - 100] + rng.standard_normal(24) * rng.choice([0.01, 0.3, 0.45, 0.6]) * np.linalg.norm(x[i - 100]) / 5
    x[290:] = x[0]
    rows = [(i, v.tolist(), i) for i, v in enumerate(x)]
    got = {r["vec_id"]: r for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, id long")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.9) & ~np.eye(len(x), dtype=bool)
    found = sum(r["n_links"] for r in got.values())
    assert all(got[i]["n_links"] <= near[i].sum() for i in got)
    assert found >= 0.99 * near.sum()
    assert [got[i]["component_id"] for i in range(300)] == roots(300, np.argwhere(near).tolist())


def test_vectors_on_awkward_rows(spark):
    schema = "vec_id long, embedding array<float>, label int, code string"
    bad = [None, [], [0.0] * 8, [1.0, None] * 4, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, [1e-30] * 8, [1e30] * 8, [1.0] * 4]
    rows = [(i, v, None, "c") for i, v in enumerate(bad)] + [(3, [1.0] * 8, 0, "c"), (None, [1.0] * 8, 0, "c"), (20, [2.0] * 8, 0, "c")]
    got = sorted((r["vec_id"] is None, r["vec_id"] or 0, r["n_links"], r["component_id"]) for r in vectors.near_vectors(spark.createDataFrame(rows, schema)).collect())
    assert got == sorted(
        [(False, i, 0, i) for i in (0, 1, 2, 3, 4, 5, 8)] + [(False, i, 3, 3) for i in (3, 6, 7, 20)] + [(True, 0, 0, None)]
    )
    assert vectors.near_vectors(spark.createDataFrame([], schema)).collect() == []


def naive_fingerprint(text):
    """The walk of one text, a step at a time."""
    level = fingerprints.level_of(len(text))
    wanted = [list(fingerprints.places(level + h)) for h in (0, 1)]
    out, at = {}, 0
    for step in range(3 * len(text)):
        kind = int(fingerprints.KIND[ord(text[at])]) if at < len(text) else fingerprints.PAD
        row = step % fingerprints.PERIOD
        out[step] = int(fingerprints.SYMBOL[row, kind])
        at += int(fingerprints.MOVE[row, kind])
    return f"{level:02d}" + "".join("0123456789abcdef-"[out.get(int(p), 16)] for h in wanted for p in h)


def test_fingerprints_equal_single_walks():
    rng = random.Random(2)
    texts = ["", "a", "é🙂"] + ["".join(rng.choice("abc dé\n") for _ in range(rng.randint(1, 700))) for _ in range(40)]
    assert fingerprints.fingerprints(texts) == [naive_fingerprint(t) for t in texts]


def test_likeness_follows_edits():
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    one = list(text)
    del one[50]
    few, other = "".join(one), "".join(rng.choice("abcdefgh ") for _ in range(3000))
    a, b, c = fingerprints.fingerprints([text, few, other])
    assert fingerprints.likeness(a, a) == 1.0
    assert fingerprints.likeness(a, b) > 0.8 > 0.4 > fingerprints.likeness(a, c)


@pytest.mark.parametrize("slice_rows", [1, 3, 1000])
def test_next_documents_in_order(spark, docs, slice_rows):
    rng = random.Random(6)
    texts = [(i * 7 % 41, "".join(rng.choice("abcdef ") for _ in range(rng.randint(0, 300)))) for i in range(41)] + [(99, None)]
    rows = {r["doc_id"]: r for r in fingerprints.fingerprint_documents(docs(*texts), slice_rows).collect()}
    order = sorted(texts, key=lambda t: -t[0])
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        made = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        marks = fingerprints.fingerprints([text, made, after])
        row = rows[i]
        assert (row["fingerprint"], row["edited_fingerprint"]) == tuple(marks[:2])
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), fingerprints.sha256_hex(made))
        assert row["near_next"] == fingerprints.likeness(marks[0], marks[2])


def test_fingerprints_on_awkward_rows(spark, docs):
    assert fingerprints.fingerprint_documents(docs()).collect() == []
    one = fingerprints.fingerprint_documents(docs("alone here")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    rows = fingerprints.fingerprint_documents(docs((1, "a b"), (1, "a b"), (None, "c"), (None, None), (5, "x" * 30_000)), 2).collect()
    assert sorted(r["n_chars"] for r in rows) == [0, 1, 3, 3, 30_000]


def test_near_documents(spark, docs):
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefgh ") for _ in range(2000))
    texts = [text, text, text[:900] + "!" + text[900:], "".join(rng.choice("abcdefgh ") for _ in range(2000)), None, ""]
    marked = fingerprints.fingerprint_documents(docs(*texts))
    got = dict(map(tuple, fingerprints.near_documents(marked).collect()))
    assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 4}
    assert fingerprints.near_documents(marked.where("false")).collect() == []


def marks_with_symbols(rng, n):
    """Fingerprints whose first band is the same in all, in families of a few changed symbols; the smallest id is like none."""
    opening, out = "".join(rng.choice("0123456789abcdef") for _ in range(12)), []
    for i in range(n):
        base = [rng.choice("0123456789abcdef") for _ in range(2 * fingerprints.SAMPLES)]
        if i > 2 and i % 3:
            base = list(out[-1][2:])
            for _ in range(rng.randint(1, 12)):
                base[rng.randrange(12, 96)] = rng.choice("0123456789abcdef")
        out.append("09" + opening + "".join(base[12:]))
    return out


def test_near_documents_equal_brute_force_behind_unlike_centres(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "BLOCK", 4)
    marks = marks_with_symbols(random.Random(12), 60)
    links = [(i, j) for i in range(60) for j in range(i) if fingerprints.likeness(marks[i], marks[j]) >= fingerprints.LIKE]
    frame = spark.createDataFrame(list(enumerate(marks)), "doc_id long, fingerprint string")
    got = dict(map(tuple, fingerprints.near_documents(frame).collect()))
    assert [got[i] for i in range(60)] == roots(60, links)
    assert len(set(got.values())) > 10 and links


def test_op8_carries_near_ids(spark):
    from tidemark.llm.queries import QUERIES

    rows = QUERIES["op8_fingerprints"](spark, "/root/testdata/sf0.001").collect()
    by_mark = {}
    for r in rows:
        by_mark.setdefault(r["fingerprint"], set()).add(r["near_id"])
    assert all(len(ids) == 1 for ids in by_mark.values()) and any(r["near_id"] != r["doc_id"] for r in rows)


def test_a_pair_of_a_hot_bucket_without_a_second_band_is_linked(spark, docs, monkeypatch):
    """All texts share one band only; the two that are alike are linked, however many classes the bucket may have."""
    words = [[f"t{t}w{i}" for i in range(60)] for t in range(8)]
    texts = [" ".join(w) for w in words] + [" ".join([*words[3][:57], "x", "y", "z"])]
    frame = docs(*texts).select("doc_id", "text")
    made = frame.coalesce(1).mapInPandas(minhash._sketches(2), minhash.SKETCH).collect()
    rows = [(r["doc_id"], r["s1"], r["n_shingles"], [7, *range(100 * r["doc_id"] + 1, 100 * r["doc_id"] + minhash.BANDS)], r["coords"]) for r in made]
    sketches = spark.createDataFrame(rows, "id long, s1 long, n_shingles long, bands array<long>, coords binary")
    placed = sketches.selectExpr("7L AS bucket", "0 AS band", "id", "s1", "id AS component")
    for hot in (4, 100):
        monkeypatch.setattr(minhash, "HOT", hot)
        got = minhash._open_links(frame, placed, sketches, 2, 80).collect()
        assert {(r["a"], r["b"]) for r in got} == {(3, 8)}


def test_rare_shingles_bring_all_similar_sets_together(spark, docs):
    """Each pair that reaches the similarity shares a bucket; texts that share only what all have do not."""
    common = [f"c{i}" for i in range(30)]
    texts = [" ".join([*common, *(f"o{t}w{i}" for i in range(30))]) for t in range(6)] + families(5, 60)
    frame = docs(*texts).select("doc_id", "text")
    made = frame.coalesce(1).mapInPandas(minhash._sketches(2), minhash.SKETCH)
    sketches = spark.createDataFrame(made.selectExpr("doc_id AS id", "s1", "n_shingles").collect(), "id long, s1 long, n_shingles long")
    open_ = sketches.selectExpr("id", "s1", "id AS component")
    buckets = {}
    for r in minhash._by_rare_shingles(frame, open_, sketches, 2, 80).collect():
        buckets.setdefault(r["bucket"], set()).add(r["id"])
    sets = [set(minhash.shingles(t, 2).tolist()) for t in texts]
    alike = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    assert len(alike) > 20 and all(any({i, j} <= b for b in buckets.values()) for i, j in alike)
    assert not any(b & set(range(6)) for b in buckets.values())


def test_rounds_over_few_edges_take_few_tasks(spark, monkeypatch):
    made = []
    monkeypatch.setattr(graph, "cut_lineage", lambda df: made.append(out := cut_lineage(df)) or out)
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long").repartition(16)
    with overridden(spark, spark__sql__shuffle__partitions=16, spark__sql__adaptive__coalescePartitions__enabled="false"):
        got = {tuple(r) for r in components(edges).collect()}
    assert got == {(i, 0) for i in range(41)}
    assert len(made) > 2 and all(df.rdd.getNumPartitions() == 1 for df in made[1:])


def test_steps_over_few_pairs_take_few_tasks(spark, docs):
    """However many shuffle partitions there are, as the driver keeps an account of each task."""
    frame = docs(*[" ".join(f"w{i}" for i in range(t, t + 40)) for t in (0, 1, 100, 101)]).select("doc_id", "text").coalesce(1)
    pairs = spark.createDataFrame([(0, 1), (0, 2), (2, 3)], "a long, b long").repartition(16)
    with overridden(spark, spark__sql__shuffle__partitions=16, spark__sql__adaptive__coalescePartitions__enabled="false"):
        links = minhash._verified(frame, pairs, 2, 80)
        assert links.rdd.getNumPartitions() == 1
        assert {tuple(r) for r in links.collect()} == {(0, 1), (2, 3)}
        edges = cut_lineage(spark.range(40).selectExpr("id AS a", "id + 1 AS b"))
        spark.sparkContext.setJobGroup("rounds", "")
        try:
            found = components(edges)
        finally:
            spark.sparkContext.setJobGroup("", "")
        assert found.rdd.getNumPartitions() <= 2
        assert {tuple(r) for r in found.collect()} == {(i, 0) for i in range(41)}
        status = spark.sparkContext.statusTracker()
        stages = {s for job in status.getJobIdsForGroup("rounds") for s in status.getJobInfo(job).stageIds}
        tasks = [info.numTasks for s in stages if (info := status.getStageInfo(s)) and info.numCompletedTasks]
        assert sorted(tasks)[-3] <= 1  # more only where the edges come in
