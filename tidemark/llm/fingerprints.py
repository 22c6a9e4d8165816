"""Document fingerprints by a randomised edit embedding.

All texts share one random function of (step, character). A walk reads a text with it: in each of three times as many steps
as the text has characters it puts out the character under its pointer, and moves on by one if the function says so. Texts
at a small edit distance have walks that meet again after an edit, and so outputs at a small Hamming distance. A fingerprint
samples the output at fixed places: ``SAMPLES`` places of a stretch whose length is a power of two, the smallest that holds
two steps per character, and as many of the stretch twice as long, so that texts of either side of such a length can be compared too.

Bands of sampled symbols make the buckets in which near duplicates meet; their likeness verifies them. In each bucket all
classes are compared with the smallest one first; what lies in different components after that is compared block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import code_points, mix64, sha256_hex, slice_starts, small_batches, text_of
from tidemark.llm.graph import components
from tidemark.llm.minhash import met_by, mixed_buckets, open_meets, spread_groups
from tidemark.session import cut_lineage

SAMPLES = 96
PERIOD = 1 << 13  # steps after which the random function repeats
ROWS = 1024  # documents fingerprinted at once, and their characters, unless a single text has more
ROWS_CHARS = 4_000_000
LANES, LANE_CHARS = 2 * ROWS + 1, 4 * ROWS_CHARS  # texts walked side by side
SLICE_ROWS = 1000
BAND_SYMBOLS, BANDS = 12, 8  # bands of a level's samples
BAND_LEAST = 6  # symbols that a band has before the text's end, to be a bucket; the first band needs one
BLOCK = 1024  # classes of a bucket that are compared with each other at once
LIKE = 0.9
PAD = 255  # stands behind a text's end; the pointer stays there

_RNG = np.random.default_rng(77)
MOVE = _RNG.integers(0, 2, (PERIOD, 256), dtype=np.uint8)
MOVE[:, PAD] = 0
SYMBOL = _RNG.integers(0, 16, (PERIOD, 256), dtype=np.uint8)
SYMBOL[:, PAD] = 16
KIND = (mix64(np.arange(0x110000, dtype=np.uint64)) % np.uint64(PAD)).astype(np.uint8)  # of each character
HEX = np.frombuffer(b"0123456789abcdef-", dtype=np.uint8)

FINGERPRINTED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def level_of(n: int) -> int:
    """The exponent of the shortest stretch that holds the usual walk of ``n`` characters, of twice as many steps."""
    return max(7, (2 * n - 1).bit_length() if n else 7)


def places(level: int) -> np.ndarray:
    """The steps at which a level is sampled, ascending."""
    share = np.random.default_rng(1000 + level).random(SAMPLES)
    return np.sort((share * (1 << level)).astype(np.int64))


def _walk(texts: list[str]) -> list[bytes]:
    """The sampled symbols of two levels for each text, all walked side by side; the texts are in order of length."""
    sizes = np.array([len(t) for t in texts])
    points = code_points("\0".join([*texts, ""]))
    kind = KIND[points]
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    kind[starts + sizes] = PAD
    levels = np.array([level_of(int(n)) for n in sizes])
    taken = np.full((len(texts), 2 * SAMPLES), 16, dtype=np.uint8)
    events: dict[int, list[tuple[int, int, int]]] = {}
    for level in np.unique(levels):
        lo, hi = np.searchsorted(levels, [level, level + 1])  # lengths ascend, so a level is a range of lanes
        for half in (0, 1):
            for k, step in enumerate(places(int(level) + half)):
                events.setdefault(int(step), []).append((int(lo), int(hi), half * SAMPLES + k))
    pointer, first = starts.copy(), 0
    last = 3 * int(sizes[-1])
    for step in range(last):
        if not step & 127:  # lanes end in order of length; a lane that has used up its steps puts out no more
            first = int(np.searchsorted(3 * sizes, step, side="right"))
            live = pointer[first:]
            if not (kind.take(live) != PAD).any():
                break
        seen = kind.take(live)
        row = step & (PERIOD - 1)
        if step in events:
            for lo, hi, k in events[step]:
                lo = max(lo, first)
                if lo < hi:
                    taken[lo:hi, k] = SYMBOL[row].take(seen[lo - first : hi - first])
        live += MOVE[row].take(seen)
    return [HEX[row].tobytes() for row in taken]


def fingerprints(texts: list[str]) -> list[str]:
    """One fingerprint per text: its level in two digits and the symbols of two levels. Equal texts have equal ones."""
    order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
    out, at = [""] * len(texts), 0
    while at < len(order):
        end, total = at, 0
        while end < len(order) and end - at < LANES and (end == at or total + len(texts[order[end]]) <= LANE_CHARS):
            total += len(texts[order[end]])
            end += 1
        for i, symbols in zip(order[at:end], _walk([texts[i] for i in order[at:end]]), strict=True):
            out[i] = f"{level_of(len(texts[i])):02d}{symbols.decode()}"
        at = end
    return out


def likeness(a: str, b: str) -> float:
    """Share of sampled places where two outputs agree, less what chance gives; 1 for equal ones, 0 for levels apart."""
    if a == b:
        return 1.0
    x, y = sorted((a, b))
    if int(y[:2]) - int(x[:2]) > 1:
        return 0.0
    if x[:2] == y[:2]:
        left, right = x[2 : 2 + SAMPLES], y[2 : 2 + SAMPLES]
    else:  # the longer stretch of the shorter text's fingerprint is the shorter one of the other
        left, right = x[2 + SAMPLES :], y[2 : 2 + SAMPLES]
    p, q = (np.frombuffer(v.encode(), np.uint8) for v in (left, right))
    told = (p != HEX[16]) | (q != HEX[16])  # places behind both ends tell nothing
    if not told.any():
        return 0.0
    return max(0.0, (float((p == q)[told].mean()) - 1 / 16) / (1 - 1 / 16))


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the beginning of another."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _fingerprint_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come by slice, in order; the last of a slice is a copy of the first of the next one, marked as such."""
    held: list[tuple[int, object, str, bool]] = []
    slice_first: str | None = None

    def done(rows: list, following: str | None) -> pd.DataFrame:
        """Fingerprints of rows of one slice; ``following`` is the text after the last."""
        texts = [r[2] for r in rows]
        nexts = [*texts[1:], following if following is not None else texts[0]]
        made = [edited(t, n) for t, n in zip(texts, nexts, strict=True)]
        marks = fingerprints([*texts, nexts[-1], *made])
        own, after, changed = marks[: len(texts)], marks[1 : len(texts) + 1], marks[len(texts) + 1 :]
        return pd.DataFrame(
            {
                "doc_id": pd.array([r[1] for r in rows], dtype="Int64"),
                "n_chars": [len(t) for t in texts],
                "edited_sha256": [sha256_hex(t) for t in made],
                "fingerprint": own,
                "edited_fingerprint": changed,
                "near_edited": [likeness(a, b) for a, b in zip(own, changed, strict=True)],
                "near_next": [likeness(a, b) for a, b in zip(own, after, strict=True)],
            }
        )

    size = 0
    for batch in batches:
        ids = [None if pd.isna(v) else int(v) for v in batch["doc_id"]]
        for row in zip(batch["slice"], ids, batch["text"], batch["copied"], strict=True):
            if held and held[0][0] != row[0]:  # a slice without a copy at its end: the only slice there is
                yield done(held, slice_first)
                held, size, slice_first = [], 0, None
            if not held and slice_first is None:
                slice_first = row[2]
            if row[3]:
                if held:
                    yield done(held, row[2])
                held, size, slice_first = [], 0, None
                continue
            if len(held) >= ROWS or size > ROWS_CHARS:
                yield done(held, row[2])
                held, size = [], 0
            held.append(row)
            size += len(row[2])
    if held:
        yield done(held, slice_first)


def fingerprint_documents(docs: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, and the likeness to the edited and to the next text.

    Takes ``doc_id, text``; other columns are ignored. The next document is the one after it in descending order of id, ties
    in the order of their texts' hashes, NULL ids last; after the last comes the first. A NULL text is empty. Of rows that
    share an id and a text all are returned. An empty table gives no rows.

    The order is cut into slices at document ids; each slice also gets a copy of the first document of the next one.
    """
    small_batches(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    slices = max(1, -(-base.select("doc_id").count() // slice_rows))
    cuts = [c for c in slice_starts(base.select("doc_id"), "doc_id", min(slices, 10_000)) if c is not None]
    top = base.agg(F.max("doc_id")).first()[0]
    cuts = sorted({*cuts, *([top] if top is not None else [])})  # slice k holds ids over cuts[k - 1], up to cuts[k]

    @F.pandas_udf("array<int>")
    def slices_of(ids: pd.Series) -> pd.Series:
        edges = np.asarray(cuts, dtype=np.int64)  # 10,000 ids at most
        out = []
        for value in ids:
            at = 0 if pd.isna(value) else int(np.searchsorted(edges, int(value)))
            first = not pd.isna(value) and at < len(edges) and edges[at] == int(value)
            out.append([at, (at + 1) % len(edges)] if first else [at])
        return pd.Series(out)

    dealt = base.select("doc_id", "text", F.posexplode(slices_of("doc_id")).alias("copy", "slice"))
    dealt = dealt.withColumn("copied", F.col("copy") == 1)
    ordered = dealt.repartition("slice").sortWithinPartitions(
        F.col("slice"), F.col("copied"), F.col("doc_id").desc_nulls_last(), F.xxhash64("text")
    )
    return ordered.select("slice", "doc_id", "text", "copied").mapInPandas(_fingerprint_rows, FINGERPRINTED)


def _block_links(like: float):
    """Links between a visitor and a resident of different components."""

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        raw = np.array([np.frombuffer(f.encode(), np.uint8) for f in rows["fingerprint"]])
        levels = (raw[:, 0].astype(int) - 48) * 10 + raw[:, 1] - 48
        halves = raw[:, 2:].reshape(-1, 2, SAMPLES)
        ids, comps, minor = rows["id"].to_numpy(), rows["component"].to_numpy(), rows["minor"].to_numpy()
        visits = rows["visits"].to_numpy()
        residents = np.flatnonzero(rows["stays"])
        found = []
        for i in np.flatnonzero(visits):
            fit = met_by(i, residents, ids, comps, minor)
            step = levels[fit] - levels[i]  # as in likeness: the shorter text's longer stretch against the other's shorter
            fit, step = fit[np.abs(step) <= 1], step[np.abs(step) <= 1]
            p, q = halves[i][(step == 1).astype(int)], halves[fit, (step == -1).astype(int)]
            told = (p != HEX[16]) | (q != HEX[16])
            n, same = told.sum(axis=1), ((p == q) & told).sum(axis=1)
            near = (n > 0) & (np.maximum(0.0, (same / np.maximum(n, 1) - 1 / 16) / (1 - 1 / 16)) >= like)
            found += [(min(ids[i], ids[j]), max(ids[i], ids[j])) for j in fit[near]]
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return compared


def _near_classes(marked: DataFrame, like: float) -> DataFrame:
    """``fingerprint, near_id`` of all fingerprints of rows with an id."""
    small_batches(marked.sparkSession)
    held = marked.where(F.col("doc_id").isNotNull() & F.col("fingerprint").isNotNull())
    classes = cut_lineage(held.groupBy("fingerprint").agg(F.min("doc_id").alias("id")))
    level = F.substring("fingerprint", 1, 2).cast("int")

    def bucket(half: int, k: int) -> Column:
        symbols = F.substring("fingerprint", 3 + half * SAMPLES + k * BAND_SYMBOLS, BAND_SYMBOLS)
        real = F.length(F.regexp_replace(symbols, "-", ""))
        return F.when(real >= (BAND_LEAST if k else 1), F.xxhash64(level + half, F.lit(k), symbols))

    bands = F.array_compact(F.array(*[bucket(half, k) for half in (0, 1) for k in range(BANDS)]))
    buckets = classes.select("id", F.explode(F.array_distinct(bands)).alias("bucket"))
    centres = buckets.groupBy("bucket").agg(F.min("id").alias("a"), F.max("id").alias("last")).where("a != last").drop("last")
    members = cut_lineage(buckets.join(centres, "bucket"))
    pairs = members.where(F.col("a") != F.col("id")).select("a", F.col("id").alias("b")).distinct()

    @F.pandas_udf("double")
    def likenesses(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([likeness(x, y) for x, y in zip(a, b, strict=True)])

    left = classes.select(F.col("id").alias("a"), F.col("fingerprint").alias("left"))
    right = classes.select(F.col("id").alias("b"), F.col("fingerprint").alias("right"))
    links = cut_lineage(pairs.join(left, "a").join(right, "b").where(likenesses("left", "right") >= like).select("a", "b"))
    found = components(links)

    # Buckets that hold more than one component yet.
    placed = members.join(found.withColumnRenamed("node", "id"), "id", "left")
    placed = placed.select("bucket", "id", F.coalesce("component", "id").alias("component"))
    keys = ["bucket", "block", "group"]
    dealt = spread_groups(open_meets(mixed_buckets(placed), BLOCK).join(classes, "id"), *keys).groupBy(*keys)
    links = links.unionByName(cut_lineage(dealt.applyInPandas(_block_links(like), "a long, b long").distinct()))
    final = components(links).withColumnRenamed("node", "id")
    return classes.join(final, "id", "left").select("fingerprint", F.coalesce("component", "id").alias("near_id"))


def with_near_ids(marked: DataFrame, like: float = LIKE) -> DataFrame:
    """The rows of ``doc_id, fingerprint`` and other columns with ``near_id``: the smallest id that their links reach, itself
    included.

    Equal fingerprints are one class. Classes that meet in a bucket are linked where the likeness of the whole fingerprints
    reaches ``like``: all are compared with the bucket's smallest first, then those of different components block by block,
    inside the tasks; so no bucket is expanded into all its pairs, and no link between components is lost. Bands of nearly
    nothing but padding are no buckets, as all texts of a level would meet there. Rows without an id or fingerprint are
    their own.
    """
    named = _near_classes(marked, like)
    placed = marked.join(named, "fingerprint", "left")
    near = F.when(F.col("doc_id").isNotNull(), F.coalesce("near_id", "doc_id")).alias("near_id")
    return placed.select(*marked.columns, near)


def near_documents(marked: DataFrame, like: float = LIKE) -> DataFrame:
    """``doc_id, near_id`` for each row of ``doc_id, fingerprint``; see ``with_near_ids``."""
    return with_near_ids(marked.select("doc_id", "fingerprint"), like).select("doc_id", "near_id")
