"""Packing of tokenized documents into sequences of fixed length.

A document's ids are cut into full pieces, which are sequences of their own, and a rest. The rests are dealt into randomised
groups of about ``GROUP_ROWS`` documents; each group is packed by first-fit decreasing, where a tournament tree over the
bins' free room finds the first bin that fits. The bins of a group that stay least full are then cut to fill the others, so
that a group ends with one sequence that is not full.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import small_batches, text_of

SEQUENCE_TOKENS = 2048
END_ID = 1
END = END_ID.to_bytes(4, "little")
GROUP_ROWS = 2000

TOKENS = "doc_id long, start long, doc_tokens long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


class FirstFit:
    """Bins of equal size; a tournament tree whose inner nodes hold the largest free room below them."""

    def __init__(self, bins: int, size: int):
        self.leaves = 1 << max(bins - 1, 0).bit_length()
        self.room = np.full(2 * self.leaves, size, dtype=np.int64).tolist()

    def place(self, length: int) -> int:
        """The first bin with room for ``length``; the room is taken."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            node += room[node] < length
        room[node] -= length
        at = node // 2
        while at:
            room[at] = max(room[2 * at], room[2 * at + 1])
            at //= 2
        return node - self.leaves


def first_fit_decreasing(lengths: list[int], size: int) -> list[int]:
    """The bin of each length. Equal lengths are placed in the order given. No length is over ``size``."""
    tree = FirstFit(max(1, len(lengths)), size)
    bins = [0] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        bins[i] = tree.place(lengths[i])
    return bins


def pack(lengths: list[int], size: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of ``(item, start in the item, length)``; all but one of them are full.

    Bins from first-fit decreasing, then the emptiest ones are taken apart and their items cut to fill the rest.
    """
    bins: dict[int, list[tuple[int, int, int]]] = {}
    for item, b in enumerate(first_fit_decreasing(lengths, size)):
        bins.setdefault(b, []).append((item, 0, lengths[item]))
    order = sorted(bins.values(), key=lambda pieces: -sum(p[2] for p in pieces))
    low, high = 0, len(order) - 1
    free = [size - sum(p[2] for p in pieces) for pieces in order]
    while low < high:
        if free[low] == 0:
            low += 1
        elif not order[high]:
            high -= 1
        else:
            item, start, length = order[high].pop()
            part = min(length, free[low])
            order[low].append((item, start, part))
            free[low] -= part
            if part < length:
                order[high].append((item, start + part, length - part))
            free[high] += part
    return [pieces for pieces in order if pieces]


#: What a byte of lower-cased text asks for: 0 nothing, 1 comma or full stop, 2 other ASCII signs, 3 anything beyond Latin letters.
BYTE_SORT = np.full(256, 2, dtype=np.uint8)
BYTE_SORT[[ord(" "), *range(ord("a"), ord("z") + 1), *range(0x80, 0xC0), *range(0xC3, 0xC9)]] = 0
BYTE_SORT[[ord(","), ord(".")]] = 1
BYTE_SORT[[ord("'"), *range(32), 127, 0xC2, *range(0xC9, 256)]] = 3
SIGN = re.compile(r"(?:[^\w\s]|_)+|\d")
#: The tokenizer's own split, a fixed value.
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Texts with these are left to the tokenizer as they are: case or white space depends on the library there.
UNSURE = re.compile("[\x1c-\x1f\x85Σİ]")


class WordEncoder:
    """Ids of whole texts under a tokenizer file of the word-end kind (lower case, white space dropped).

    Such a tokenizer treats every word on its own. The same merges are given to a second library, whose byte-pair loop is
    several times faster: a space stands for the mark at a word's end, so that each word is followed by one. Texts that need
    more than lower case and a split at signs take the tokenizer's own pattern, or the tokenizer itself. Equality with the
    tokenizer on whole texts is tested.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        if model.get("end_of_word_suffix") != "</w>":
            raise ValueError(f"not a tokenizer of the word-end kind: {path}")
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}  # bytes written as themselves; the rest from 256 on
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - plain))}
        special = {t for t in model["vocab"] if t.startswith("<|")}
        ranks = {}
        for token, rank in model["vocab"].items():
            if token not in special:
                stem = token.removesuffix("</w>")
                ranks[bytes(byte_of[c] for c in stem) + b" " * (stem != token)] = rank
        words = tiktoken.Encoding("words", pat_str=r"[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        self.words = words._core_bpe.encode_ordinary  # the public call adds a check for surrogates, which cannot occur here

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        low = (text.lower() + "\n").replace("\n", " ")
        raw = np.frombuffer(low.encode("utf-8", "replace"), dtype=np.uint8)
        sort = BYTE_SORT[raw]
        most = sort.max()
        if most == 3:
            if UNSURE.search(text) or not unicodedata.is_normalized("NFC", text):
                return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
            low = PRETOKEN.sub(r"\g<0> ", text.lower())
            low = " ".join(low.split()) + " "
        elif most == 2 or self._crowded(raw, sort) or b"\xc3\x97" in (b := raw.tobytes()) or b"\xc3\xb7" in b:
            low = SIGN.sub(r" \g<0> ", low)
        else:
            low = low.replace(", ", " , ").replace(". ", " . ")
        return array("I", self.words(low)).tobytes()

    @staticmethod
    def _crowded(raw: np.ndarray, sort: np.ndarray) -> bool:
        """Whether a comma or full stop has another before it, or no space after it."""
        at = np.flatnonzero(sort)
        return bool(len(at)) and bool(at[0] == 0 or sort[at - 1].any() or (raw[at + 1] != 32).any())


_ENCODERS: dict[str, WordEncoder] = {}  # one per worker and file


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def document_ids(docs: DataFrame, path: str) -> DataFrame:
    """Per document its id and its ids with the end id, as little-endian unsigned 32-bit numbers; NULL text is empty."""
    small_batches(docs.sparkSession)

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        for batch in batches:
            ids = [encode(t) + END for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": ids})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInPandas(
        encoded, "doc_id long, ids binary"
    )


def pack_documents(docs: DataFrame, path: str, size: int = SEQUENCE_TOKENS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Pieces of all documents in sequences of at most ``size`` tokens.

    Takes ``doc_id, text``; other columns are ignored. Each row is a document of its own, repeated rows included; an empty or
    NULL text is its end id alone. Equal lengths are packed in the order of document id and ids. An empty table gives no
    pieces. ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers.

    Sequence ids: full pieces and groups number their sequences within ranges of their own, from the piece's row hash and
    from the group; they are unique, not consecutive.
    """
    groups = max(1, -(-docs.count() // group_rows))
    small_batches(docs.sparkSession)
    width = 4 * size

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encode(text) + END
                rows += [(doc_id, at // 4, len(ids) // 4, ids[at : at + width]) for at in range(0, len(ids), width)]
            yield pd.DataFrame(rows, columns=["doc_id", "start", "doc_tokens", "ids"]).astype({"doc_id": "Int64"})

    def pack_group(key: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["doc_id", "start", "ids"], kind="stable", ignore_index=True)
        ids, rows = pieces["ids"].tolist(), []
        items = list(zip(pieces["doc_id"], pieces["start"], pieces["doc_tokens"], strict=True))
        for k, sequence in enumerate(pack([len(x) // 4 for x in ids], size)):
            offset = 0
            for item, start, length in sequence:
                doc_id, first, tokens = items[item]
                part = ids[item][4 * start : 4 * (start + length)]
                rows.append((doc_id, first + start, length, zlib.crc32(part), tokens, key[0] + groups * k, offset, part))
                offset += length
        names = [x.split()[0] for x in PIECES.split(", ")]
        return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInPandas(cut, TOKENS)
    # Full pieces join the groups too: they take a sequence each and cost the packing nothing.
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids"), F.lit(groups)))
    return dealt.groupBy("part").applyInPandas(pack_group, PIECES)
