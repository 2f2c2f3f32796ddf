"""Token counts: byte pairs merged in a heap over a linked list, no ids made."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache, partial
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwarden.llm.common import Memo, texts_of
from tillwarden.llm.library_ids import JOINING_SPACE, ODD_SPACE

# Fixed value: how byte-level tokenizers split text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORDS_KEPT = 400_000
PIECES_KEPT = 600_000


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 stands for itself; the other bytes, in order, are the
    characters from 256 on.
    """
    itself = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in itself else chr(next(others)) for b in range(256)]


def merged_length(symbols: list[int], ranks: dict[int, int], made: list[int]) -> int:
    """Symbols left when the lowest-rank adjacent pair, leftmost first, is merged till none is.

    ``ranks`` has the rank of a pair under ``left << 32 | right``, ``made`` the
    symbol each rank makes. A heap entry is a rank and a place in one number; the
    entry of a pair that a merge has since broken is told by its symbols.
    """
    size = left = len(symbols)
    after = list(range(1, size + 1))
    before = list(range(-1, size - 1))
    heap = []
    for i in range(size - 1):
        rank = ranks.get(symbols[i] << 32 | symbols[i + 1])
        if rank is not None:
            heap.append(rank * size + i)
    heapify(heap)
    while heap:
        rank, i = divmod(heappop(heap), size)
        j = after[i]
        here = symbols[i]
        if here < 0 or j >= size or ranks.get(here << 32 | symbols[j]) != rank:
            continue
        here = symbols[i] = made[rank]
        symbols[j] = -1
        left -= 1
        k = after[i] = after[j]
        if k < size:
            before[k] = i
            rank = ranks.get(here << 32 | symbols[k])
            if rank is not None:
                heappush(heap, rank * size + i)
        h = before[i]
        if h >= 0:
            rank = ranks.get(symbols[h] << 32 | here)
            if rank is not None:
                heappush(heap, rank * size + h)
    return left


class PairCounter:
    """Counts the tokens of texts by the merges of a byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        split, model = spec["pre_tokenizer"], spec["model"]
        if spec["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"]:
            raise ValueError(f"{path} is no plain byte-level tokenizer")
        vocab = model["vocab"]
        self.of_byte = [vocab[c] for c in byte_characters()]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks, self.made = {}, []
        for rank, (a, b) in enumerate(pairs):
            self.ranks[vocab[a] << 32 | vocab[b]] = rank
            self.made.append(vocab[a + b])
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added)) if added else "(?!)")
        self.cut = regex.compile(PATTERN).findall
        self.pieces = Memo(self._piece, PIECES_KEPT)
        self.words = Memo(self._word, WORDS_KEPT)

    def _piece(self, piece: str) -> int:
        of_byte = self.of_byte
        return merged_length([of_byte[b] for b in piece.encode()], self.ranks, self.made)

    def _plain(self, text: str) -> int:
        return sum(map(self.pieces.__getitem__, self.cut(text)))

    def _word(self, word: str) -> int:
        return self._plain(" " + word)

    def _segment(self, text: str) -> int:
        """A space before anything but white space always starts a piece."""
        words = JOINING_SPACE.split(text) if ODD_SPACE.search(text) else text.split(" ")
        return self._plain(words[0]) + sum(map(self.words.__getitem__, words[1:]))

    def count(self, text: str) -> int:
        """Tokens of a text; the string of an added token in it is one token."""
        if not self.added.search(text):
            return self._segment(text)
        parts = self.added.split(text)
        return len(parts) - 1 + sum(map(self._segment, parts))


@lru_cache(maxsize=2)
def pair_counter(path: str) -> PairCounter:
    return PairCounter(path)


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    count = pair_counter(path).count
    for batch in batches:
        found = pa.array([count(t) for t in texts_of(batch)], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_bytes"), found],
            names=["doc_id", "n_bytes", "n_tokens"],
        )


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """Bytes and tokens of every text, and whether the tokens are more than ``limit``.

    One row per row of ``docs``, in no order; no shuffle. A null or empty text has
    0 bytes and 0 tokens. Repeated rows and null ids are kept as they are. Very
    long texts are counted whole, in time n log n of the longest unbroken piece.
    Other columns of ``docs`` are not read.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
    )
    counted = rows.mapInArrow(
        partial(_count, path=path), "doc_id long, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
