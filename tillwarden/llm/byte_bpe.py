"""Byte-level BPE by a rank file: boundaries found by a scan of transition functions.

Splitting text by the pattern is done by a small automaton over classes of code
points. Each code point is a function from state to state; functions compose,
and composition is associative, so blocks of text are scanned side by side and
then joined, with array operations only. No regular expression runs on the text.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, partial
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwarden.llm.common import Memo, pieces_of, texts_of

PIECES_KEPT = 500_000
CHUNK = 1 << 20
ROW = 64

# Classes of code points, then the symbols the automaton reads.
LETTER, NUMBER, OTHER, SPACE, BLANK, APOSTROPHE, END = range(7)
(S_LETTER, S_NUMBER, S_OTHER, S_JOIN, S_LAST, S_MID, S_TWO, S_THREE, S_END) = range(9)
# States after a code point. FRESH: the next one starts a piece. JOINED: a space
# that belongs to what follows. ONE and TWO: so many letters of a contraction to go.
FRESH, IN_LETTER, IN_NUMBER, IN_OTHER, JOINED, IN_BLANK, ONE, TWO = range(8)
# What \s is, and the contractions.
WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SHORT = "stmd"
LONG = ("re", "ve", "ll")
SENTINEL = 0x110000


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point, and of the sentinel behind each text."""
    table = np.full(SENTINEL + 1, OTHER, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for point in range(SENTINEL):
        kind = kinds.get(unicodedata.category(chr(point))[0])
        if kind is not None:
            table[point] = kind
    table[WHITE] = BLANK
    table[0x20], table[ord("'")], table[SENTINEL] = SPACE, APOSTROPHE, END
    return table


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether the code point starts a piece."""
    if symbol == S_END:
        return FRESH, False
    if symbol == S_LETTER and state in (ONE, TWO):
        return state - 1 if state == TWO else FRESH, False
    inside = {S_LETTER: IN_LETTER, S_NUMBER: IN_NUMBER, S_OTHER: IN_OTHER, S_MID: IN_BLANK}
    if symbol in inside:
        goes_on = state == inside[symbol] or state == JOINED and symbol != S_MID
        return inside[symbol], not goes_on
    if symbol in (S_TWO, S_THREE):
        if state in (IN_OTHER, JOINED):
            return IN_OTHER, False
        return (ONE if symbol == S_TWO else TWO), True
    return (JOINED if symbol == S_JOIN else FRESH), True


@lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, ...]:
    """Next states, piece starts, each symbol's function, all functions and their composition."""
    steps = [[_step(state, symbol) for symbol in range(9)] for state in range(8)]
    follow = np.array([[s for s, _ in row] for row in steps], np.uint8)
    starts = np.array([[b for _, b in row] for row in steps], bool)
    symbols = [tuple(int(x) for x in follow[:, symbol]) for symbol in range(9)]
    functions = {tuple(range(8)): 0}
    waiting = list(functions)
    while waiting:
        first = waiting.pop()
        for then in symbols:
            made = tuple(then[s] for s in first)
            if made not in functions:
                functions[made] = len(functions)
                waiting.append(made)
    table = np.array(list(functions), np.uint8)
    composed = np.array(
        [[functions[tuple(b[s] for s in a)] for b in functions] for a in functions], np.uint16
    )
    of_symbol = np.array([functions[s] for s in symbols], np.uint16)
    return follow, starts, of_symbol, table, composed


def symbols_of(points: np.ndarray) -> np.ndarray:
    """The symbol of each code point: its class and what the next two say about it."""
    kind = classes()[points]
    following = np.append(kind[1:], END)
    blank = (kind == SPACE) | (kind == BLANK)
    before_text = ~((following == SPACE) | (following == BLANK) | (following == END))
    symbols = np.array([S_LETTER, S_NUMBER, S_OTHER, S_MID, S_MID, S_OTHER, S_END], np.uint8)[kind]
    symbols[blank & before_text] = S_LAST
    symbols[(kind == SPACE) & before_text] = S_JOIN
    quotes = np.flatnonzero(kind == APOSTROPHE)
    if len(quotes):
        padded = np.append(points, [SENTINEL, SENTINEL]).astype(np.int64)
        one, two = padded[quotes + 1], padded[quotes + 2]
        symbols[quotes[np.isin(one, [ord(c) for c in SHORT])]] = S_TWO
        long = [ord(a) << 32 | ord(b) for a, b in LONG]
        symbols[quotes[np.isin(one << 32 | two, long)]] = S_THREE
    return symbols


def piece_starts(points: np.ndarray) -> np.ndarray:
    """Where pieces start among the code points of texts that each end in the sentinel."""
    follow, starts, of_symbol, table, composed = automaton()
    symbols = symbols_of(points)
    rows = -(-len(symbols) // ROW)
    grid = np.full(rows * ROW, S_END, np.uint8)
    grid[: len(symbols)] = symbols
    grid = np.ascontiguousarray(grid.reshape(rows, ROW).T)

    done = np.zeros(rows, np.uint16)  # each row's function: its symbols composed
    for column in grid:
        done = composed[done, of_symbol[column]]
    apart = 1
    while apart < rows:  # composed with those of all rows before
        done[apart:] = composed[done[:-apart], done[apart:]]
        apart *= 2
    state = np.full(rows, FRESH, np.uint8)
    state[1:] = table[done[:-1], FRESH]
    found = np.empty(grid.shape, bool)
    for k, column in enumerate(grid):
        found[k] = starts[state, column]
        state = follow[state, column]
    return np.flatnonzero(found.T.reshape(-1)[: len(symbols)])


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a piece: the adjacent pair of the lowest rank is merged, leftmost first."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    # A part is known by where it starts and ends; a heap entry is a rank and a start.
    size = len(piece)
    ends, starts = list(range(1, size + 1)), list(range(-1, size - 1))  # of this part, of the one before
    heap = []
    for i in range(size - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            heap.append(rank * size + i)
    heapify(heap)
    while heap:
        rank, i = divmod(heappop(heap), size)
        j = ends[i]
        if j <= 0 or j >= size or ranks.get(piece[i : ends[j]]) != rank:
            continue
        k = ends[i] = ends[j]
        ends[j] = 0
        if k < size:
            starts[k] = i
            rank = ranks.get(piece[i : ends[k]])
            if rank is not None:
                heappush(heap, rank * size + i)
        h = starts[i]
        if h >= 0:
            rank = ranks.get(piece[h:k])
            if rank is not None:
                heappush(heap, rank * size + h)
    ids, i = [], 0
    while i < size:
        ids.append(ranks[piece[i : ends[i]]])
        i = ends[i]
    return ids


class RankCoder:
    """Encodes and decodes by a file of base64 tokens and ranks."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            pairs = (line.split() for line in file if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.of_id = {rank: token for token, rank in self.ranks.items()}
        self.known = Memo(self._ids, PIECES_KEPT)
        self.decoded = Memo(self._bytes, PIECES_KEPT)

    def _ids(self, piece: str) -> bytes:
        return np.array(merge(piece.encode(), self.ranks), "<u4").tobytes()

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Each text's ids, and the ends of its pieces counted in ids, little-endian 32-bit."""
        arrays = []
        for text in texts:
            arrays.append(np.frombuffer(text.encode("utf-32-le"), np.uint32))
            arrays.append(np.array([SENTINEL], np.uint32))
        starts = piece_starts(np.concatenate(arrays)) if arrays else np.empty(0, np.int64)
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        at = np.concatenate([[0], np.cumsum(sizes)])
        cuts = np.searchsorted(starts, at)
        get, ids, ends = self.known.__getitem__, [], []
        for i, text in enumerate(texts):
            own = (starts[cuts[i] : cuts[i + 1]] - at[i]).tolist()
            found = [get(text[a:b]) for a, b in zip(own, [*own[1:], len(text)], strict=False)]
            ids.append(b"".join(found))
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            ends.append((np.cumsum(lengths) // 4).astype("<u4").tobytes())
        return ids, ends

    def _bytes(self, ids: bytes) -> bytes:
        return b"".join(map(self.of_id.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode(self, ids: bytes, ends: bytes) -> list[bytes]:
        """The bytes of each piece, cut by the offsets kept from encoding; pieces that come again are remembered."""
        stops = (4 * np.frombuffer(ends, "<u4").astype(np.int64)).tolist()
        if (stops[-1] if stops else 0) != len(ids):
            raise ValueError("the last piece does not end where the ids do")
        get = self.decoded.__getitem__
        return [get(ids[a:b]) for a, b in zip([0, *stops], stops, strict=False)]


@lru_cache(maxsize=2)
def rank_coder(path: str) -> RankCoder:
    return RankCoder(path)


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    coder = rank_coder(path)
    for batch in batches:
        texts, keys = texts_of(batch), batch.column("doc_id")
        for a, b in pieces_of([len(t) for t in texts], CHUNK):
            ids, ends = coder.encode(texts[a:b])
            yield pa.RecordBatch.from_arrays(
                [keys.slice(a, b - a), pa.array(ids, pa.binary()), pa.array(ends, pa.binary())],
                names=["doc_id", "ids", "piece_ends"],
            )


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    coder = rank_coder(path)
    for batch in batches:
        rows = zip(batch.column("ids").to_pylist(), batch.column("piece_ends").to_pylist(), strict=True)
        decoded = [b"".join(coder.decode(ids, ends)) for ids, ends in rows]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(decoded, pa.binary())], names=[*batch.schema.names, "decoded"]
        )


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``piece_ends`` of every text.

    ``ids`` are little-endian unsigned 32-bit integers; ``piece_ends`` says after
    how many ids each piece ends. One row per row of ``docs``, no shuffle. A null
    or empty text has no ids. Texts of any length are encoded whole; strings of
    special tokens are ordinary text. Other columns of ``docs`` are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(partial(_encode, path=path), "doc_id long, ids binary, piece_ends binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The rows of :func:`encode` with the ``decoded`` bytes; an id without a token is an error."""
    return encoded.select("doc_id", "ids", "piece_ends").mapInArrow(
        partial(_decode, path=path), "doc_id long, ids binary, piece_ends binary, decoded binary"
    )
