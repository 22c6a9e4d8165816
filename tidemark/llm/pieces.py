"""SentencePiece encoding and decoding, with a max-plus parallel scan for giant documents.

Documents up to ``GIANT`` characters are encoded by the library. A longer one is split into chunks that different tasks
work on. A state at the boundary of two chunks is a piece that covers the last character before it; a path's weight is 0 if
every two neighbouring pieces may stand side by side in a byte-pair encoding, and minus infinity otherwise, so that the best
path over all chunks is the one encoding of the document. Each chunk yields the matrix of best weights from the states at
its left to those at its right boundary; the matrices of a document are multiplied in the max-plus semiring by an
associative scan, forwards and backwards; and each chunk traces its own pieces back between the two states found.

Two pieces may stand side by side if encoding their joined text gives the two again. A text has exactly one sequence of
pieces all of whose neighbours may; tests compare it with the library. The model must be of the byte-pair kind with identity
normalisation, the kind of file that is installed here; others raise an error.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, text_of

GIANT = 65_536
CHUNK = 16_384
SPACE = "▁"
NEVER = float("-inf")
RESET = re.compile(f"(?<=[^{SPACE}]){SPACE}")

Token = tuple[int, int] | None  # start and end in a chunk's window; None is a fresh start
START: Token = None


class Pieces:
    """A model's vocabulary as a lattice, and the library's processor."""

    def __init__(self, path: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        sp = self.processor
        ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.ids = {sp.id_to_piece(i): i for i in ids}
        self.rank = {sp.id_to_piece(i): -sp.get_score(i) for i in ids}
        self.letters = {c for piece in self.ids for c in piece}
        self.longest = max(map(len, self.ids))
        probe = "ab  cd\nÅngström "
        split = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        if split or any(c not in self.ids for c in self.letters) or sp.decode(sp.encode(probe)) != probe:
            raise ValueError(f"not a byte-pair model with identity normalisation: {path}")
        self.own: dict[str, bool] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """Byte-pair encoding of a short text: the best-ranked pair first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            ranks = [self.rank.get(a + b, float("inf")) for a, b in zip(parts, parts[1:], strict=False)]
            k = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[k] == float("inf"):
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def stands(self, piece: str) -> bool:
        """Whether the text is a piece, or a character without one, that encodes to itself."""
        known = self.own.get(piece)
        if known is None:
            known = piece in self.ids and self.merged(piece) == [piece] or len(piece) == 1
            self.own[piece] = known
        return known

    def beside(self, left: str, right: str) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            known = self.pairs[left, right] = self.merged(left + right) == [left, right]
        return known

    def numbers(self, piece: str) -> list[int]:
        known = self.ids.get(piece)
        return [known] if known is not None else [self.processor.piece_to_id(f"<0x{b:02X}>") for b in piece.encode()]

    def states(self, text: str, at: int) -> list[Token]:
        """Pieces that cover the character before ``at``: they start before it and end there or later."""
        reach = self.longest
        return [
            (a, b)
            for a in range(max(0, at - reach), at)
            for b in range(at, min(len(text), a + reach) + 1)
            if self.stands(text[a:b])
        ]

    def sweep(self, text: str, begin: int, until: int, heads: list[tuple[Token, int]]) -> tuple[dict, dict]:
        """All tokens that start before ``until``, with the set of heads (as bits) whose paths reach them.

        Heads end at ``begin`` or later. Returns the bits of the tokens that cover ``until`` or end there, and for tracing
        the first predecessor of every token.
        """
        ends: dict[int, list[tuple[Token, int]]] = {}
        for token, bits in heads:
            ends.setdefault(begin if token is None else token[1], []).append((token, bits))
        came: dict[Token, Token] = {}
        out: dict[Token, int] = {t: bits for t, bits in heads if t is not None and t[1] >= until}
        if begin >= until:
            out |= {t: bits for t, bits in heads if t is None}
        for at in range(begin, until):
            befores = ends.pop(at, None)
            if not befores:
                continue
            for end in range(at + 1, min(len(text), at + self.longest) + 1):
                piece = text[at:end]
                if not self.stands(piece):
                    continue
                bits, token = 0, (at, end)
                for before, reached in befores:
                    if before is None or self.beside(text[before[0] : before[1]], piece):
                        if not bits:
                            came[token] = before
                        bits |= reached
                if bits:
                    ends.setdefault(end, []).append((token, bits))
                    if end >= until:
                        out[token] = bits
        return out, came

    def resets(self, text: str, begin: int, end: int) -> tuple[int, int] | None:
        """First and last place of a chunk where every piece ends: before a word's space."""
        found = [m.start() for m in RESET.finditer(text, begin, end) if begin < m.start() < end]
        return (found[0], found[-1]) if found else None

    def matrix(self, text: str, begin: int, end: int, final: bool) -> np.ndarray:
        """Best weights from the states at ``begin`` (or the text's start) to those at ``end`` (or its end)."""
        ins = self.states(text, begin) if begin else [START]
        outs = [None] if final else self.states(text, end)
        heads = [(t, 1 << k) for k, t in enumerate(ins)]
        places = self.resets(text, begin, end)
        out = np.full((len(ins), len(outs)), NEVER)
        first = places[0] if places else end
        reached, _ = self.sweep(text, begin, first, heads)
        if places:
            through = 0
            for token, bits in reached.items():
                if token is None or token[1] == first:
                    through |= bits
            reached, _ = self.sweep(text, places[1], end, [(START, through)])
        for k, target in enumerate(outs):
            bits = 0
            for token, reach in reached.items():
                if token == target or final and (token is None or token[1] == end):
                    bits |= reach
            for i in range(len(ins)):
                if bits >> i & 1:
                    out[i, k] = 0.0
        return out

    def trace(self, text: str, begin: int, end: int, source: int, target: int, final: bool) -> list[int]:
        """Ids of the pieces that start in the chunk, between the given states."""
        head = self.states(text, begin)[source] if begin else START
        goal = None if final else self.states(text, end)[target]
        places = self.resets(text, begin, end)
        if not places:
            return self._traced(text, begin, end, head, goal)
        left = self._traced(text, begin, places[0], head, None)
        # Between the resets the library works alone: it puts the leading space back itself.
        inner = self.processor.encode(text[places[0] + 1 : places[1]].replace(SPACE, " ")) if places[0] < places[1] else []
        return left + inner + self._traced(text, places[1], end, START, goal)

    def _traced(self, text: str, begin: int, end: int, head: Token, goal: Token) -> list[int]:
        reached, came = self.sweep(text, begin, end, [(head, 1)])
        if goal is None:
            goal = next(t for t in reached if t is None or t[1] == end)
        pieces: list[str] = []
        while goal is not None and goal != head:
            pieces.append(text[goal[0] : goal[1]])
            goal = came[goal]
        return [i for piece in reversed(pieces) for i in self.numbers(piece)]


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two matrices in the max-plus semiring."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def prefix_products(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """Products of the first one, two, ... matrices, by pairwise combination as in a parallel scan."""
    if len(matrices) < 2:
        return list(matrices)
    halves = prefix_products([product(a, b) for a, b in zip(matrices[::2], matrices[1::2], strict=False)])
    out = [matrices[0]]
    for k in range(1, len(matrices)):
        out.append(halves[k // 2] if k % 2 else product(halves[k // 2 - 1], matrices[k]))
    return out


def chosen_states(matrices: list[np.ndarray]) -> list[int]:
    """The state at each inner boundary on the best path through all matrices."""
    ahead = prefix_products(matrices)
    behind = prefix_products([m.T for m in reversed(matrices)])[::-1]
    return [int(np.argmax(ahead[k][0] + behind[k + 1][0])) for k in range(len(matrices) - 1)]


_MODELS: dict[str, Pieces] = {}  # one per worker and file


def model(path: str) -> Pieces:
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]


def _binary(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


WINDOW = "key string, chunk int, chunks int, window string, begin int, end int"


def encode_documents(docs: DataFrame, path: str, giant: int = GIANT, chunk: int = CHUNK) -> DataFrame:
    """Per document its ids as little-endian unsigned 32-bit numbers.

    Takes ``doc_id, text``; other columns are ignored. Returns ``doc_id, ids``, one row per row. A NULL text is empty and has
    no ids. Repeated rows are encoded alike. A giant text goes through the scan once, however many rows repeat it. An empty
    table gives no rows.
    """
    small_batches(docs.sparkSession)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    size = F.length("text")

    def short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sp = model(path).processor
        for batch in batches:
            ids = [_binary(sp.encode(t)) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].array, "ids": ids})

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reach = model(path).longest
        for batch in batches:
            for key, text in zip(batch["key"], batch["text"], strict=True):
                text = SPACE + text.replace(" ", SPACE)
                cuts = [*range(0, len(text) - chunk // 2, chunk), len(text)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    low = max(0, a - reach)
                    window = text[low : b + reach]
                    yield pd.DataFrame([(key, k, len(cuts) - 1, window, a - low, b - low)], columns=[x.split()[0] for x in WINDOW.split(", ")])

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model(path)
        for batch in batches:
            made = [
                m.matrix(w, a, b, k == n - 1)
                for w, a, b, k, n in zip(*(batch[c] for c in ("window", "begin", "end", "chunk", "chunks")), strict=True)
            ]
            yield pd.DataFrame(
                {"key": batch["key"], "chunk": batch["chunk"], "ins": [x.shape[0] for x in made], "weights": [x.ravel() for x in made]}
            )

    def scanned(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk", ignore_index=True)
        states = chosen_states([np.asarray(w).reshape(n, -1) for w, n in zip(rows["weights"], rows["ins"], strict=True)])
        return pd.DataFrame({"key": key[0], "chunk": rows["chunk"], "source": [0, *states], "target": [*states, 0]})

    def traced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = model(path)
        names = ("window", "begin", "end", "source", "target", "chunk", "chunks")
        for batch in batches:
            ids = [
                _binary(m.trace(w, a, b, i, o, k == n - 1)) for w, a, b, i, o, k, n in zip(*(batch[c] for c in names), strict=True)
            ]
            yield pd.DataFrame({"key": batch["key"], "chunk": batch["chunk"], "ids": ids})

    def joined(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"key": [key[0]], "ids": [b"".join(rows.sort_values("chunk")["ids"])]})

    large = base.where(size > giant).withColumn("key", F.sha2("text", 256))
    split = large.dropDuplicates(["key"]).mapInPandas(windows, WINDOW).repartition("key", "chunk")
    weights = split.mapInPandas(matrices, "key string, chunk int, ins int, weights array<double>")
    places = weights.groupBy("key").applyInPandas(scanned, "key string, chunk int, source int, target int")
    parts = split.join(places, ["key", "chunk"]).mapInPandas(traced, "key string, chunk int, ids binary")
    whole = parts.groupBy("key").applyInPandas(joined, "key string, ids binary")
    encoded = base.where(size <= giant).mapInPandas(short, "doc_id long, ids binary")
    return encoded.unionByName(large.select("doc_id", "key").join(whole, "key").select("doc_id", "ids"))


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text`` of ``doc_id, ids``; a NULL has no ids. The reverse of encoding for texts without U+2581."""
    small_batches(encoded.sparkSession)

    @F.pandas_udf("string")
    def decoded(ids: pd.Series) -> pd.Series:
        sp = model(path).processor
        return pd.Series([sp.decode(np.frombuffer(x or b"", dtype="<u4").tolist()) for x in ids], dtype=object)

    return encoded.select("doc_id", "ids", decoded("ids").alias("text"))

