"""Phrase collocations by set-oriented relational mining.

The texts become a relation of occurrences, sorted by piece and position: a place in its document for each word, where the next
piece begins one place further on, so that two words stand side by side exactly if their places differ by one. Level by level

1. the occurrences are merge-joined with themselves at adjacent places, which makes groups one word longer,
2. the groups are counted,
3. the occurrences of the frequent ones (a semi-join) are written, sorted, for the next level.

An occurrence relation is written in the order it is read, and no row of it is cut between tasks; so the merge-joins need no
shuffle, and making them once for the counts and once for the occurrences is cheaper than to store rare groups. The semi-join marks
the frequent groups as bits of a map of fixed size, which is what is broadcast, however many groups there are: a few rare groups may
pass, and fall out when they are counted as a part of longer ones. Counts are merged inside a task, then by Spark.

A word stands for its 64-bit hash with its language, a group for the hash of the two groups it is made of. (Of 10^9 words one shares
its hash with one of 10^6 frequent ones with a chance of 1 in 18,000; two names of one frequent group are an error.)
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import mix64, small_batches, text_of, true_runs
from tidemark.session import cut_lineage, scratch_path
from tidemark.sources.storage import remove_folder

LEAST = 30  # occurrences of a frequent group
LONGEST = 4  # words
PERCENT = 80  # of a phrase's occurrences inside one longer phrase, from where it says nothing of its own
FIRST = 2000  # phrases of a language
FACTOR = 2_000_000

MAP_BITS = 26  # 8 MB
MERGE_ROWS = 1 << 21  # counts held by a task before they are merged
SEEN = 1 << 22  # names that a task remembers to have given
ROW_WORDS = 1 << 16  # of an occurrence row, about; cut only between pieces

_RNG = np.random.default_rng(1205)
BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
BYTE[ord("A") : ord("Z") + 1] = BYTE[ord("a") : ord("z") + 1]  # lower-cases A-Z
BASE = np.uint64(0x2545F4914F6CDD1D)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
BREAK = np.zeros(256, dtype=bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
GAP = BREAK.copy()
GAP[[0x20, 0x09]] = True
SEGMENT = 1 << 20
_POWER = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(SEGMENT, BASE, dtype=np.uint64))), dtype=np.uint64)
_INVERSE = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(SEGMENT, INVERSE, dtype=np.uint64))), dtype=np.uint64)

COUNTED = pa.schema([("left", pa.int64()), ("right", pa.int64()), ("n", pa.int64()), ("lang", pa.string())])
COUNTED_SQL = "left long, right long, n long, lang string"
_OCCURRENCES = [("place", pa.list_(pa.int32())), ("item", pa.list_(pa.int64()))]
KEPT = pa.schema([*_OCCURRENCES, ("named", pa.int64()), ("lang", pa.string()), ("text", pa.string())])
KEPT_SQL = "place array<int>, item array<long>, named long, lang string, text string"


# --- words -----------------------------------------------------------------------------------------------------------


def _word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word, a polynomial of its bytes; segment by segment, each ending where a word does."""
    out = np.zeros(len(starts), dtype=np.uint64)
    k = 0
    while k < len(starts):
        begin = int(starts[k])
        last = max(k + 1, int(np.searchsorted(ends, begin + SEGMENT, side="right")))
        stop = int(ends[last - 1])
        if stop - begin > SEGMENT:  # one very long word
            word = np.zeros(1, np.uint64)
            for at in range(begin, stop, SEGMENT):
                part = raw[at : min(at + SEGMENT, stop)]
                word = mix64(word + (BYTE[part] * _POWER[: len(part)]).sum(dtype=np.uint64))
            out[k] = word[0]
        else:
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE[raw[begin:stop]] * _POWER[: stop - begin], dtype=np.uint64)))
            a, b = starts[k:last] - begin, ends[k:last] - begin
            out[k:last] = (sums[b] - sums[a]) * _INVERSE[a]
        k = last
    return mix64(out + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, place, start and end of each word of a text's bytes."""
    starts, ends = true_runs(~GAP[raw], 1)
    breaks = np.flatnonzero(BREAK[raw])
    pieces = np.searchsorted(breaks, starts)  # breaks before the word
    new = np.concatenate(([0], np.cumsum(np.diff(pieces) > 0))) if len(starts) else np.zeros(0, np.int64)
    return _word_hashes(raw, starts, ends), np.arange(len(starts), dtype=np.int64) + new, starts, ends


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The group that two adjacent groups make."""
    mixed = left.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix64(right.view(np.uint64))
    return mix64(mixed).view(np.int64)


class _Counts:
    """Counts of items, each with the two groups it is made of (a word: itself), merged whenever many have come together."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.rows = 0

    def add(self, items: np.ndarray, left: np.ndarray, right: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        """Count the items; gives what has to leave the task."""
        unique, first, n = np.unique(items, return_index=True, return_counts=True)
        self.parts.append((unique, left[first], n) if right is None else (unique, left[first], n, right[first]))
        self.rows += len(unique)
        if self.rows > MERGE_ROWS:
            self._merge()
            if self.rows > MERGE_ROWS // 2:
                yield from self.rest()

    def _merge(self) -> None:
        items, left, n, *right = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        order = np.argsort(items)
        items = items[order]
        first = np.flatnonzero(np.concatenate(([True], items[1:] != items[:-1])))
        one = order[first]
        self.parts = [(items[first], left[one], np.add.reduceat(n[order], first), *[r[one] for r in right])]
        self.rows = len(first)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            self._merge()
            _, left, n, *right = self.parts[0]
            yield _batch(COUNTED, left=left, n=n, **({"right": right[0]} if right else {}))
        self.parts, self.rows = [], 0


class _Seen:
    """Which keys a task has met."""

    def __init__(self):
        self.keys = np.zeros(0, np.int64)

    def new(self, keys: np.ndarray) -> np.ndarray:
        """Which of the distinct ``keys`` are met for the first time."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        fresh = self.keys[at] != keys if len(self.keys) else np.ones(len(keys), bool)
        if fresh.any():
            self.keys = np.union1d(self.keys if len(self.keys) <= SEEN else self.keys[:0], keys[fresh])
        return fresh


def _batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    rows = len(next(iter(columns.values())))
    made = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(made, schema=schema)


def _occurring(lengths, place: np.ndarray, item: np.ndarray) -> pa.RecordBatch:
    """Occurrence rows of the given lengths; empty ones are left out."""
    lengths = np.asarray(lengths)
    offsets = pa.array(np.concatenate(([0], np.cumsum(lengths[lengths > 0]))), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(v, k)) for v, k in ((place, pa.int32()), (item, pa.int64()))]
    return _batch(KEPT, place=lists[0], item=lists[1])


def _texts(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Language, bytes, and item, place, start and end of each word, for each text with words."""
    seeds: dict[str, np.ndarray] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
        raw = np.frombuffer(text.as_buffer(), dtype=np.uint8)
        if not len(raw):
            continue
        if lang not in seeds:
            seeds[lang] = mix64(np.array([hash_of(lang)], dtype=np.uint64))
        hashes, place, starts, ends = words(raw)
        if len(hashes):
            yield lang, raw, mix64(hashes + seeds[lang]).view(np.int64), place, starts, ends


def _cuts(place: np.ndarray) -> list[int]:
    """Where a document's row is cut: between pieces, about every ROW_WORDS words."""
    if len(place) <= ROW_WORDS:
        return [0, len(place)]
    ends = np.flatnonzero(np.diff(place) > 1) + 1
    cuts = [0]
    while len(place) - cuts[-1] > ROW_WORDS:
        k = int(np.searchsorted(ends, cuts[-1] + ROW_WORDS))
        if k == len(ends):
            break
        cuts.append(int(ends[k]))
    return [*cuts, len(place)]


def hash_of(lang: str) -> int:
    raw = np.frombuffer(lang.encode(), dtype=np.uint8)
    return int(_word_hashes(raw, np.array([0]), np.array([len(raw)]))[0]) if len(raw) else 0


LOWER = bytes(range(256)).lower()  # A-Z alone


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the words, and of all words of a language (without an item)."""
    counts, totals = _Counts(), {}
    for batch in batches:
        items = []
        for lang, _, item, *_ in _texts(batch):
            items.append(item)
            totals[lang] = totals.get(lang, 0) + len(item)
        if items:
            every = np.concatenate(items)
            yield from counts.add(every, every)
    yield from counts.rest()
    if totals:
        yield _batch(COUNTED, n=list(totals.values()), lang=list(totals))


def _word_rows(marks):
    """Occurrences of the marked words, and their texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in batches:
            lengths, places, items, texts = [], [], [], []
            for lang, raw, item, place, starts, ends in _texts(batch):
                kept = np.flatnonzero(_has(marks.value, item))
                place = place[kept]
                lengths += np.diff(_cuts(place)).tolist()
                places.append(place)
                items.append(item[kept])
                texts.append((lang, raw, starts[kept], ends[kept]))
            if not lengths:
                continue
            item = np.concatenate(items)
            if not len(item):
                continue
            yield _occurring(lengths, np.concatenate(places), item)
            unique, first = np.unique(item, return_index=True)
            new = seen.new(unique)
            begins = np.concatenate(([0], np.cumsum([len(i) for i in items])))
            named, langs, words_ = unique[new], [], []
            for at, doc in zip(first[new], np.searchsorted(begins, first[new], side="right") - 1, strict=True):
                lang, raw, starts, ends = texts[doc]
                k = at - begins[doc]
                langs.append(lang)
                words_.append(raw[starts[k] : ends[k]].tobytes().translate(LOWER).decode("utf-8", "replace"))
            if len(named):
                yield _batch(KEPT, named=named, lang=langs, text=words_)

    return rows


# --- one level -------------------------------------------------------------------------------------------------------


def _has(marks: np.ndarray, items: np.ndarray) -> np.ndarray:
    bit = items & ((1 << MAP_BITS) - 1)
    return ((marks[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(bool)


def _adjacent(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Row, place, left and right item of each group one word longer.

    The rows are sorted by place, so a merge-join of adjacent places looks one entry ahead.
    """
    lists = batch.column("place")
    place, item = lists.flatten().to_numpy(zero_copy_only=False), batch.column("item").flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    left = np.flatnonzero((place[1:] - place[:-1] == 1) & (row[1:] == row[:-1]))
    return row[left], place[left], item[left], item[left + 1]


def _group_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = _Counts()
    for batch in batches:
        _, _, left, right = _adjacent(batch)
        yield from counts.add(joined(left, right), left, right)
    yield from counts.rest()


def _group_rows(marks):
    """Occurrences of the marked groups."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, place, left, right = _adjacent(batch)
            item = joined(left, right)
            kept = _has(marks.value, item)
            if kept.any():
                yield _occurring(np.bincount(row[kept]), place[kept], item[kept])

    return rows


def _joined(left: str, right: str) -> Column:
    """The ids of groups, for those that are frequent."""

    @F.pandas_udf("long")
    def made(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(joined(a.to_numpy(dtype=np.int64), b.to_numpy(dtype=np.int64)))

    return made(left, right)


def _marked(spark: SparkSession, groups: DataFrame):
    """The groups as bits of a map of 2^MAP_BITS, broadcast."""
    place = F.col("item").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    found = groups.select(place.alias("place")).groupBy(F.shiftright("place", 15).alias("part"))
    found = found.agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit(32767))).alias("bits"))
    marks = np.zeros(1 << (MAP_BITS - 3), dtype=np.uint8)
    for row in found.collect():  # 2^(MAP_BITS - 15) rows of 4 KB at most
        marks[row["part"] * 4096 : (row["part"] + 1) * 4096] = np.frombuffer(row["bits"], dtype=np.uint8)
    return spark.sparkContext.broadcast(marks)


def collocations(
    docs: DataFrame, least: int = LEAST, percent: int = PERCENT, first: int = FIRST, longest: int = LONGEST
) -> DataFrame:
    """The ``first`` phrases per language, by how much more often their words stand together than apart.

    Takes ``text, lang``; other columns are ignored. Returns ``lang, rank, phrase, a, l, r, n, score``. A NULL text is empty, a NULL
    language ``und``. Every row counts, also repeated ones. Ties of score and count are ordered by the phrase's bytes. A language
    without a frequent phrase has no rows, and so has an empty table. ``longest`` is 2 at least.

    Words and groups below ``least`` never get into a later level. The occurrence relations lie in the shared folder and are
    removed one by one as the next is written; the counts of frequent groups are checkpointed.
    """
    spark = docs.sparkSession
    small_batches(spark)
    base = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_of().alias("text"))
    folder = scratch_path(spark, "collocations")

    def written(rows: DataFrame, level: int) -> DataFrame:
        path = f"{folder}/level={level}"
        rows.write.option("compression", "zstd").option("parquet.block.size", 32 << 20).parquet(path)
        if level > 1:
            remove_folder(spark, f"{folder}/level={level - 1}")
        return spark.read.schema(rows.schema).parquet(path)

    def one_name_each(named: DataFrame) -> DataFrame:
        named = cut_lineage(named)
        if not named.groupBy("item").count().where("count > 1").isEmpty():
            raise RuntimeError("two words or groups share a hash; use another BASE")
        return named

    try:
        counts = base.mapInArrow(_word_counts, COUNTED_SQL).groupBy(F.col("left").alias("item"), "lang").agg(F.sum("n").alias("f"))
        counts = cut_lineage(counts.where(F.col("item").isNull() | (F.col("f") >= least)))
        totals = counts.where("item IS NULL").select("lang", F.col("f").alias("n"))
        often = counts.where("item IS NOT NULL").select("item", "f")
        held = written(base.mapInArrow(_word_rows(_marked(spark, often)), KEPT_SQL), 1)
        names = held.where("named IS NOT NULL").select(F.col("named").alias("item"), "lang", F.col("text").alias("phrase"))
        names = names.distinct().join(often, "item")
        levels = [one_name_each(names.select("lang", "item", "phrase", "f", F.array("item").alias("words")))]
        for level in range(2, longest + 1):
            occurrences = held.where("place IS NOT NULL").select("place", "item")
            counts = occurrences.mapInArrow(_group_counts, COUNTED_SQL).groupBy("left", "right").agg(F.sum("n").alias("f"))
            often = cut_lineage(counts.where(F.col("f") >= least).withColumn("item", _joined("left", "right")))
            left = levels[-1].select(F.col("item").alias("left"), "lang", "words", "phrase")
            right = levels[-1].select(F.col("item").alias("right"), F.element_at("words", -1).alias("last"))
            last = levels[0].select(F.col("item").alias("last"), F.col("phrase").alias("word"))
            named = often.join(left, "left").join(right, "right").join(last, "last")
            phrase, ids = F.concat_ws(" ", "phrase", "word"), F.concat("words", F.array("last"))
            levels.append(one_name_each(named.select("lang", "item", phrase.alias("phrase"), "f", ids.alias("words"))))
            if level < longest:
                held = written(occurrences.mapInArrow(_group_rows(_marked(spark, often)), KEPT_SQL), level)
    finally:
        remove_folder(spark, folder)
    return _ranked(levels, totals, percent, first)


def _ranked(levels: list[DataFrame], totals: DataFrame, percent: int, first: int) -> DataFrame:
    """Scores of the frequent groups of two words and more, those inside a longer one left out, the best of each language."""

    def stacked(frames: list[DataFrame]) -> DataFrame:
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame)
        return out

    every = stacked(levels).select("words", "f")
    candidates = cut_lineage(stacked(levels[1:]).select("lang", "words", "phrase", F.col("f").alias("a")))
    size = F.size("words")

    cuts = candidates.select("words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns({"head": F.slice("words", 1, F.col("k")), "tail": F.slice("words", F.col("k") + 1, size)})
    cuts = cuts.join(every.select(F.col("words").alias("head"), F.col("f").alias("l")), "head")
    cuts = cuts.join(every.select(F.col("words").alias("tail"), F.col("f").alias("r")), "tail")
    score = F.expr(f"CAST(a AS DECIMAL(20,0)) * {FACTOR} DIV (CAST(l AS DECIMAL(20,0)) + r)")
    best = cuts.withColumn("score", score).groupBy("words").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    parts = candidates.where(size > 2).select(F.col("a").alias("longer"), "words", F.explode(F.sequence(F.lit(2), size - 1)).alias("m"))
    parts = parts.select("longer", "words", "m", F.explode(F.sequence(F.lit(1), size - F.col("m") + 1)).alias("at"))
    inside = parts.groupBy(F.slice("words", F.col("at"), F.col("m")).alias("words")).agg(F.max("longer").alias("longer"))

    found = candidates.join(best, "words").join(inside, "words", "left")
    own = F.coalesce(F.col("longer"), F.lit(0)).cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * percent
    found = found.where(own).select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    # The last shuffle is of ``first`` rows a language; the counts per language are few.
    ranked = ranked.join(totals, "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
