"""Near duplicates by word shingles: fast similarity sketching, banding, exact verification.

A sketch has ``BANDS * ROWS`` coordinates. In round ``i`` every shingle is thrown into one coordinate by a hash of its own,
with the round as the leading part of its value; a second set of rounds throws all shingles into one given coordinate each,
so that every coordinate is filled at last. The smallest value stays. Two sets agree in a coordinate with a chance of their
Jaccard similarity, and the share of agreeing coordinates is as concentrated as that of independent ones.

Equal sets are one class and are sketched once. In each bucket of equal bands all classes are compared with the smallest
one, on full sets. Where a bucket's classes still lie in different components, those outside the largest are compared with
all of it inside the tasks, block by block: by size, by sketch, and by the upper halves of the smallest ``FINE`` hashes of
both sets, which are all of them but in long texts. A bucket of more than ``HOT`` classes is first split by a second band, so that unlike
classes part. What is still apart in such a bucket then meets by its rarest shingles, of which any two similar sets share one;
so ``HOT`` decides how a bucket is compared, and not what is found. Halves of hashes can only make sets look more alike than they
are, so no link is ruled out by them. Only links that join components, and pairs of long texts that may be links, leave the tasks; their full sets decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.llm.common import likely_among, mix64, small_batches, text_of, true_runs
from tidemark.llm.graph import components, in_few_tasks
from tidemark.session import cut_lineage

BANDS, ROWS = 42, 6  # a pair of similarity 0.8 shares no band with a chance of 3e-6
COORDINATES = BANDS * ROWS
BLOCK = 1024  # classes of a bucket that are compared with each other at once
HOT = 16 * BLOCK  # classes of a bucket from where it is split; a pair of similarity 0.8 in it shares no second band with a chance of 4e-5
FINE = 1024  # hashes of a set that go with a class into a bucket's blocks; all of them, if there are no more
PART_PAIRS, PART_IDS = 500, 5000  # pairs that a task verifies at least, ids that it looks up
SPREAD = 4.5  # standard deviations below the similarity, from where a sketch rules a pair out

STATS = ("main", "size", "most")  # of a bucket with several components
SKETCH = "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>, coords binary"

_RNG = np.random.default_rng(20_25)
BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
BYTE[ord("A") : ord("Z") + 1] = BYTE[ord("a") : ord("z") + 1]  # lower-cases A-Z
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
ROUND = _RNG.integers(0, 2**64, 2 * COORDINATES, dtype=np.uint64)
BASE = np.uint64(0x5851F42D4C957F2D)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
SEGMENT = 1 << 20  # bytes hashed at once


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, base, dtype=np.uint64))), dtype=np.uint64)


_POWER, _INVERSE = _powers(BASE, 1 << 12), _powers(INVERSE, 1 << 12)


def _word_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of the bytes, in order."""
    global _POWER, _INVERSE
    if len(_POWER) <= len(raw):
        _POWER, _INVERSE = _powers(BASE, 2 * len(raw)), _powers(INVERSE, 2 * len(raw))
    starts, ends = true_runs(~SPACE[raw], 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE[raw] * _POWER[: len(raw)], dtype=np.uint64)))
    return mix64((sums[ends] - sums[starts]) * _INVERSE[starts] + (ends - starts).astype(np.uint64))


def words(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if len(raw) <= SEGMENT:
        return _word_hashes(raw)
    cuts, at = [0], SEGMENT  # long texts in segments that end at white space
    while at < len(raw):
        ahead = np.flatnonzero(SPACE[raw[at : at + SEGMENT]])
        if len(ahead):
            cuts.append(at + int(ahead[0]))
        at += SEGMENT
    return np.concatenate([_word_hashes(raw[a:b]) for a, b in zip(cuts, [*cuts[1:], len(raw)], strict=True)])


def shingles(text: str, width: int) -> np.ndarray:
    """The distinct shingles of ``width`` words as sorted 64-bit hashes; a shorter text is one shingle, no word none."""
    w = words(text)
    if not len(w):
        return w
    width = min(width, len(w))
    out = np.full(len(w) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + w[i : len(w) - width + 1 + i])
    return np.unique(out)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The coordinates of a set that is not empty."""
    t, empty = np.uint64(COORDINATES), np.uint64(2**64 - 1)
    coords = np.full(COORDINATES, empty)
    done, step = 0, max(1, min(32, 3 * COORDINATES // len(hashes)))
    while done < COORDINATES and (coords == empty).any():
        rounds = np.arange(done, min(done + step, COORDINATES))
        thrown = mix64(hashes[None, :] ^ ROUND[rounds, None])
        value = (thrown >> np.uint64(9)) | (rounds.astype(np.uint64) << np.uint64(55))[:, None]
        np.minimum.at(coords, (thrown % t).ravel().astype(np.int64), value.ravel())
        done += step
    for k in np.flatnonzero(coords == empty):
        thrown = mix64(hashes ^ ROUND[COORDINATES + k])
        coords[k] = (thrown >> np.uint64(9)).min() | np.uint64((COORDINATES + int(k)) << 55)
    return coords


def _band_keys(coords: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in coords.reshape(BANDS, ROWS).T:
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def _sums(hashes: np.ndarray) -> tuple[int, int]:
    """Two sums over a set that tell it from others."""
    s1, s2 = (np.sum(x, dtype=np.uint64).astype(np.int64) for x in (mix64(hashes), mix64(hashes ^ ROUND[0])))
    return int(s1), int(s2)


def _sketches(width: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                h = shingles(text, width)
                if not len(h):
                    out.append((0, 0, 0, np.zeros(0, np.int64), b""))
                    continue
                coords = sketch(h)
                out.append((len(h), *_sums(h), _band_keys(coords), mix64(coords).astype(np.uint8).tobytes()))
            made = pd.DataFrame(out, columns=["n_shingles", "s1", "s2", "bands", "coords"])
            made.insert(0, "doc_id", batch["doc_id"].array)
            yield made

    return rows


def _full_sets(width: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(t, width).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "shingles": sets})

    return rows


def _fine_sets(width: int, given: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(t, width) for t in batch["text"]]
            firsts = [_sums(h)[0] for h in sets]
            halves = [(h[:given] >> np.uint64(32)).astype(np.uint32).tobytes() for h in sets]
            yield pd.DataFrame({"id": batch["id"], "s1": firsts, "fine": halves})

    return rows


def _hash_sets(width: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingles(t, width) for t in batch["text"]]
            firsts = [_sums(h)[0] for h in sets]
            yield pd.DataFrame({"id": batch["id"], "s1": firsts, "shingles": [h.view(np.int64) for h in sets]})

    return rows


def _reaches(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets, as sorted hashes, are similar enough."""
    short, long = (x, y) if len(x) <= len(y) else (y, x)
    if 100 * len(short) < percent * len(long):
        return False
    at = np.minimum(np.searchsorted(long, short), len(long) - 1)
    same = int((long[at] == short).sum())
    return 100 * same >= percent * (len(short) + len(long) - same)


def _similar(percent: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep, last, x = [], None, np.zeros(0, np.uint64)
            for left, right in zip(batch["left"], batch["right"], strict=True):
                if left != last:
                    last, x = left, np.frombuffer(left, dtype=np.uint64)
                keep.append(_reaches(x, np.frombuffer(right, dtype=np.uint64), percent))
            yield batch.loc[keep, ["a", "b"]]

    return rows


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``id, text`` of the documents whose ids are given."""
    return likely_among(docs.select(F.col("doc_id").alias("id"), "text"), "id", ids).join(ids, "id")


def _verified(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets reach the similarity, in as many tasks as the pairs are worth."""
    pairs, tasks = in_few_tasks(pairs, PART_PAIRS)
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    ids, _ = in_few_tasks(ids, PART_IDS)
    sets = _texts_of(docs, ids).mapInPandas(_full_sets(width), "id long, shingles binary")
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("right"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").coalesce(tasks)
    return joined.mapInPandas(_similar(percent), "a long, b long").distinct().coalesce(tasks)


def _fine_reach(x: np.ndarray, y: np.ndarray, whole: bool, percent: int, given: int) -> bool:
    """Whether two sets, of which the upper halves of the ``given`` smallest hashes are known, can be similar enough."""
    if whole:
        return _reaches(x, y, percent)
    ends = [z[-1] for z in (x, y) if len(z) == given]  # up to the smaller end both are known
    x, y = (z[: np.searchsorted(z, min(ends), "right")] for z in (x, y))
    short, long = (x, y) if len(x) <= len(y) else (y, x)
    at = np.minimum(np.searchsorted(long, short), len(long) - 1)
    same = int((long[at] == short).sum())
    seen, limit = len(short) + len(long) - same, percent / 100
    return same >= seen * (limit - SPREAD * (limit * (1 - limit) / seen) ** 0.5)


def _block_links(percent: int, given: int):
    """Likely links between a visitor and a resident of different components, to be decided by their full sets.

    Of those between the same components one is enough, if the sets are whole.
    """
    limit = percent / 100
    least = int(COORDINATES * (limit - SPREAD * (limit * (1 - limit) / COORDINATES) ** 0.5))

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        coords = np.array([np.frombuffer(c, dtype=np.uint8) for c in rows["coords"]])
        bands = np.stack(rows["before"].to_numpy())
        fine = [np.frombuffer(x, dtype=np.uint32) for x in rows["fine"]]
        ids, comps, minor = rows["id"].to_numpy(), rows["component"].to_numpy(), rows["minor"].to_numpy()
        sizes, visits = rows["n_shingles"].to_numpy(), rows["visits"].to_numpy()
        band, second = int(rows["band"].iloc[0]), int(rows["second"].iloc[0])
        residents = np.flatnonzero(rows["stays"])
        up: dict[int, int] = {}

        def top(c: int) -> int:
            while up.get(c, c) != c:
                c = up[c]
            return c

        joined, open_ = [], []
        for i in np.flatnonzero(visits):
            fit = met_by(i, residents, ids, comps, minor)
            fit = fit[100 * np.minimum(sizes[fit], sizes[i]) >= percent * np.maximum(sizes[fit], sizes[i])]
            fit = fit[(coords[fit] == coords[i]).sum(axis=1) >= least]
            # A pair that shares several buckets is compared in the first of them.
            shared = bands[fit] == bands[i]
            if second >= 0:
                shared[:, band] = False
            for j in fit[~shared.any(axis=1)]:
                ours, theirs = top(comps[i]), top(comps[j])
                whole = max(sizes[i], sizes[j]) <= given
                if ours != theirs and _fine_reach(fine[i], fine[j], whole, percent, given):
                    if whole:
                        up[ours] = theirs
                    (joined if whole else open_).append((i, j))
        found = joined + [(i, j) for i, j in open_ if top(comps[i]) != top(comps[j])]
        return pd.DataFrame([(min(ids[i], ids[j]), max(ids[i], ids[j])) for i, j in found], columns=["a", "b"], dtype=np.int64)

    return compared


def mixed_buckets(placed: DataFrame) -> DataFrame:
    """The rows of buckets with several components, with the bucket's ``main`` component, its ``most`` rows, and all ``size`` rows.

    ``placed`` has ``bucket, component`` and other columns.
    """
    counts = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    main = counts.groupBy("bucket").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("size"), F.max("n").alias("most")
    )
    return placed.join(main.where(F.col("most") < F.col("size")), "bucket")


def _by_second_band(mixed: DataFrame, sketches: DataFrame) -> DataFrame:
    """``mixed`` with ``second``: classes of buckets over ``HOT`` are dealt into buckets of a later band besides."""
    cold = mixed.where(F.col("size") <= HOT).withColumn("second", F.lit(-1))
    hot = mixed.where(F.col("size") > HOT).drop(*STATS)
    if hot.isEmpty():
        return cold
    keys = likely_among(sketches.select("id", "s1", "bands"), "id", hot.select("id"))
    split = hot.join(keys.dropDuplicates(["id", "s1"]), ["id", "s1"])
    split = split.select(*hot.columns, F.posexplode("bands").alias("second", "key")).where(F.col("second") > F.col("band"))
    split = cut_lineage(split.withColumn("bucket", F.xxhash64("bucket", "key")).drop("key"))
    return cold.unionByName(mixed_buckets(split))


def _by_rare_shingles(docs: DataFrame, open_: DataFrame, sketches: DataFrame, width: int, percent: int) -> DataFrame:
    """The classes ``id, s1, component`` with a ``bucket`` for each of their rarest shingles, so that all similar ones meet.

    All sets are put in one order: by the number of classes that have a shingle, then by the shingle. Two sets of ``n`` and
    ``m`` shingles that are similar enough share ``percent`` percent of both, hence one of each set's first ``n - percent * n / 100``
    and one. A shingle of a single class takes a place there, and makes no bucket.
    """
    ids = open_.select("id").distinct()
    sets = _texts_of(docs, ids).mapInPandas(_hash_sets(width), "id long, s1 long, shingles array<long>")
    own = likely_among(sketches.select("id", "s1", "n_shingles"), "id", ids).join(open_, ["id", "s1"]).dropDuplicates(["id", "s1"])
    sets = sets.dropDuplicates(["id", "s1"]).join(own, ["id", "s1"])
    each = cut_lineage(sets.select("id", "s1", "component", "n_shingles", F.explode("shingles").alias("bucket")))
    counts = each.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    known = each.join(counts, "bucket").groupBy("id", "s1", "component", "n_shingles")
    known = known.agg(F.array_sort(F.collect_list(F.struct("n", "bucket"))).alias("rare"))
    places = F.col("n_shingles") - F.ceil(F.col("n_shingles") * percent / 100 - 1e-6) + 1
    taken = F.greatest(F.lit(0), places - (F.col("n_shingles") - F.size("rare"))).cast("int")
    return known.select("id", "s1", "component", F.explode(F.slice("rare", 1, taken)).alias("rare")).select(
        F.col("rare.bucket").alias("bucket"), F.lit(0).alias("band"), "id", "s1", "component"
    )


def open_meets(mixed: DataFrame, block_rows: int) -> DataFrame:
    """The rows of ``mixed_buckets``, dealt out so that all classes of different components of a bucket meet in a block.

    ``mixed`` has ``id`` too; ``minor, block, group, stays, visits`` take the place of the bucket's sizes. A bucket's most
    frequent component needs no comparison within itself. All other classes, the minor ones, visit every block of the
    bucket's classes; visitors come in blocks as well. A minor class stays in the block of its own that its group visits, so
    one row is both there. So a bucket of one block costs a row per class, and one of a large component and a few others a
    row per class and block of others.
    """
    rest = mixed.withColumn("minor", F.col("component") != F.col("main"))
    rest = rest.withColumn("blocks", F.ceil(F.col("size") / block_rows).cast("int"))
    rest = rest.withColumn("groups", F.ceil((F.col("size") - F.col("most")) / block_rows).cast("int"))
    hashed = F.xxhash64("id")
    block, group = F.pmod(hashed, F.col("blocks")).cast("int"), F.pmod(hashed, F.col("groups")).cast("int")

    def meet(at_block, at_group, stays, visits):
        return F.struct(at_block.alias("block"), at_group.alias("group"), stays.alias("stays"), visits.alias("visits"))

    def upto(count: str):
        return F.sequence(F.lit(0), F.col(count) - 1)

    own = F.transform(upto("groups"), lambda j: meet(block, j, F.lit(True), F.col("minor") & (j == group)))
    others = F.filter(upto("blocks"), lambda j: j != block)
    goes = F.transform(others, lambda j: meet(j, group, F.lit(False), F.lit(True)))
    met = F.explode(F.when(F.col("minor"), F.concat(own, goes)).otherwise(own)).alias("meet")
    kept = [c for c in mixed.columns if c not in STATS]
    return rest.select(*kept, "minor", met).select(*kept, "minor", "meet.*")


def met_by(i: int, residents: np.ndarray, ids: np.ndarray, comps: np.ndarray, minor: np.ndarray) -> np.ndarray:
    """The residents of other components that visitor ``i`` is compared with; of two minor ones the smaller's visit counts."""
    return residents[(comps[residents] != comps[i]) & (~minor[residents] | (ids[residents] > ids[i]))]


def spread_groups(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows by key over all shuffle partitions: few bytes may be much work, so they are not to be put together."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _links_among(docs: DataFrame, split: DataFrame, sketches: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between different components of a bucket of ``split``, which has ``second`` besides what ``mixed_buckets`` gives."""
    dealt = cut_lineage(open_meets(split, BLOCK))
    ids, _ = in_few_tasks(dealt.select("id").distinct(), PART_IDS)
    fine = _texts_of(docs, ids).mapInPandas(_fine_sets(width, FINE), "id long, s1 long, fine binary")
    known = likely_among(sketches, "id", ids).join(fine, ["id", "s1"])
    keys = ["bucket", "band", "second", "block", "group"]
    before = F.slice("bands", 1, F.greatest("band", "second")).alias("before")  # the bands of earlier buckets
    light = [*dealt.columns, "n_shingles", "coords", "fine", before]
    met = spread_groups(dealt.join(known.dropDuplicates(["id", "s1"]), ["id", "s1"]).select(*light), *keys)
    likely = met.groupBy(*keys).applyInPandas(_block_links(percent, FINE), "a long, b long").distinct()
    return _verified(docs, likely, width, percent)


def _open_links(docs: DataFrame, placed: DataFrame, sketches: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between different components of a bucket; ``placed`` has ``bucket, band, id, s1, component``."""
    seen = Observation()
    mixed = cut_lineage(mixed_buckets(cut_lineage(placed)).observe(seen, F.max("size").alias("largest")))
    if (seen.get["largest"] or 0) <= HOT:
        return _links_among(docs, mixed.withColumn("second", F.lit(-1)), sketches, width, percent)
    links = _links_among(docs, _by_second_band(mixed, sketches), sketches, width, percent)
    hot = mixed.where(F.col("size") > HOT)
    # A pair of a hot bucket may share no second band; what the links leave apart there is compared by its rarest shingles.
    links = cut_lineage(links)
    ties = mixed.select(F.col("id").alias("a"), F.col("component").alias("b")).distinct()
    found = components(links.unionByName(ties)).withColumnRenamed("node", "id").withColumnRenamed("component", "top")
    hot = hot.drop(*STATS).join(found, "id", "left").withColumn("component", F.coalesce("top", "component")).drop("top")
    open_ = cut_lineage(mixed_buckets(hot).select("id", "s1", "component").distinct())
    rare = cut_lineage(mixed_buckets(cut_lineage(_by_rare_shingles(docs, open_, sketches, width, percent))))
    return links.unionByName(_links_among(docs, rare.withColumn("second", F.lit(-1)), sketches, width, percent))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per document its set's size and its component of links of at least ``percent`` percent Jaccard similarity.

    Takes ``doc_id, text``; other columns are ignored. Returns ``doc_id, n_shingles, component_id, kept``, one row per row.
    A NULL text is empty; a document without words is linked with nothing. A document id is one node: rows that share it
    share a component. Rows without an id are linked with nothing, have no component, and are kept. An empty table gives no
    rows.
    """
    small_batches(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    sketched = cut_lineage(base.mapInPandas(_sketches(width), SKETCH))
    held = sketched.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))

    classes = held.groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("id"))
    classes = cut_lineage(classes)
    own = held.drop("coords").join(classes, ["s1", "s2", "n_shingles"]).where(F.col("doc_id") == F.col("id"))

    buckets = own.select("id", "s1", F.posexplode("bands").alias("band", "bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("id").alias("centre"), F.max("id").alias("last"))
    shared = shared.where(F.col("centre") != F.col("last")).select("bucket", "centre")
    members = cut_lineage(buckets.join(shared, "bucket"))

    pairs = members.where(F.col("id") != F.col("centre")).select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    links = cut_lineage(_verified(base, pairs, width, percent))
    found = cut_lineage(components(links))

    # Buckets that hold more than one component yet.
    placed = members.join(found.withColumnRenamed("node", "id"), "id", "left")
    placed = placed.select("bucket", "band", "id", "s1", F.coalesce("component", "id").alias("component"))
    sketches = held.select(F.col("doc_id").alias("id"), "s1", "n_shingles", "bands", "coords")
    links = links.unionByName(cut_lineage(_open_links(base, placed, sketches, width, percent)))

    # Documents under one id with different sets tie their classes together.
    tagged = held.select("doc_id", "n_shingles", "s1", "s2").join(classes, ["s1", "s2", "n_shingles"]).select("doc_id", "id")
    repeated = tagged.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("b")).where(F.col("a") != F.col("b"))
    ties = tagged.join(repeated.select("doc_id"), "doc_id").select(F.col("doc_id").alias("a"), F.col("id").alias("b")).distinct()
    final = components(links.unionByName(ties))

    named = classes.join(final.withColumnRenamed("node", "id"), "id", "left")
    named = named.select("s1", "s2", "n_shingles", F.coalesce("component", "id").alias("component_id"))
    light = sketched.select("doc_id", "n_shingles", "s1", "s2")
    placed = light.join(named, ["s1", "s2", "n_shingles"], "left")
    linked = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    component = F.when(linked, F.col("component_id")).otherwise(F.col("doc_id"))
    return placed.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
