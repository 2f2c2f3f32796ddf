"""Packing: documents cut and placed in sequences under several limits at once.

Each piece of a document is a vector of tokens, segments and loss-bearing tokens.
An open sequence takes the piece whose vector has the largest dot product with
the room that is left, both in shares of the limits, among the pieces that fit;
when none fits, a piece is cut to fill the room.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwarden.llm.common import pieces_of
from tillwarden.llm.library_ids import library_ids

CHUNK = 4 << 20
POOL_TOKENS = 1 << 17
LAYOUT = "doc_id long, start long, ids binary, doc_tokens long, loss_tokens long, sequence_id long, offset long"
# Sequences of one task are numbered from its partition times this.
PER_PARTITION = 1 << 33


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 1024
    segments: int = 128
    loss_tokens: int = 1024

    def __post_init__(self):
        if min(self.tokens, self.segments, self.loss_tokens) < 1:
            raise ValueError("limits must be at least 1")


@dataclass(slots=True)
class Piece:
    """Some ids of a document, of which the first ``free`` bear no loss."""

    doc_id: int | None
    start: int
    ids: bytes
    doc_tokens: int
    free: int

    def __len__(self) -> int:
        return len(self.ids) // 4

    @property
    def loss(self) -> int:
        return len(self) - self.free

    def cut(self, size: int) -> tuple[Piece, Piece]:
        head = Piece(self.doc_id, self.start, self.ids[: 4 * size], self.doc_tokens, min(self.free, size))
        rest = max(self.free - size, 0)
        return head, Piece(self.doc_id, self.start + size, self.ids[4 * size :], self.doc_tokens, rest)


class Packer:
    """Takes pieces, gives full sequences; holds at most a pool of pieces."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.pool: list[Piece] = []
        self.held = 0

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """What is as long as a sequence is one; the rest, cut to the limits, waits in the pool."""
        limits = self.limits
        while len(piece) > limits.tokens or piece.loss > limits.loss_tokens:
            head, piece = piece.cut(min(limits.tokens, piece.free + limits.loss_tokens))
            yield from self._keep(head)
        yield from self._keep(piece)
        if self.held >= POOL_TOKENS or len(self.pool) >= POOL_TOKENS // 32:
            yield from self.fill(POOL_TOKENS // 4)

    def _keep(self, piece: Piece) -> Iterator[list[Piece]]:
        if len(piece) == self.limits.tokens:
            yield [piece]
        elif len(piece):
            self.pool.append(piece)
            self.held += len(piece)

    def fill(self, keep: int = 0) -> Iterator[list[Piece]]:
        """Sequences made of the pool until at most ``keep`` tokens are left.

        The last ones have room for the largest power of two that is left, so that
        they need no padding.
        """
        limits = self.limits
        sizes = np.array([len(p) for p in self.pool], np.int64)
        losses = np.array([p.loss for p in self.pool], np.int64)
        left, many = int(sizes.sum()), len(self.pool)
        while left > keep and left or many >= POOL_TOKENS // 64:
            room = limits.tokens if left >= limits.tokens else 1 << (left.bit_length() - 1)
            loss_room, taken = limits.loss_tokens, []
            while room and left and len(taken) < limits.segments:
                slots = limits.segments - len(taken)
                chosen = self._best(sizes, losses, room, slots, loss_room)
                if chosen is None:
                    break
                piece = self.pool[chosen]
                size = min(room, piece.free + loss_room)
                if len(piece) > size:
                    piece, rest = piece.cut(size)
                    self.pool[chosen], sizes[chosen], losses[chosen] = rest, len(rest), rest.loss
                else:
                    sizes[chosen] = losses[chosen] = 0
                    many -= 1
                taken.append(piece)
                room -= len(piece)
                loss_room -= piece.loss
                left -= len(piece)
            yield taken
        self.pool = [p for p, size in zip(self.pool, sizes, strict=True) if size]
        self.held = left

    def _best(self, sizes: np.ndarray, losses: np.ndarray, room: int, slots: int, loss_room: int) -> int | None:
        """The place of the piece to take next, whole or cut; None if nothing can be added."""
        limits = self.limits
        fits = (sizes > 0) & (sizes <= room) & (losses <= loss_room)
        # The last segment should use up the room: only a piece of that size is taken whole.
        if slots == 1:
            fits &= sizes == room
        score = (
            sizes * (room / limits.tokens**2)
            + slots / limits.segments**2
            + losses * (loss_room / limits.loss_tokens**2)
        )
        chosen = int(np.argmax(np.where(fits, score, -1.0)))
        if fits[chosen]:
            return chosen
        # None fits whole: of which a cut fills most of the room, and among these what bears most loss.
        filled = np.minimum(np.minimum(sizes, sizes - losses + loss_room), room)
        chosen = int(np.argmax(filled * (limits.tokens + 1) + np.minimum(losses, limits.tokens)))
        return chosen if filled[chosen] > 0 and sizes[chosen] else None


def _pack(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int, limits: Limits
) -> Iterator[pa.RecordBatch]:
    encoder, packer = library_ids(path), Packer(limits)
    end = np.array([end_id], "<u4").tobytes()
    sequence = TaskContext.get().partitionId() * PER_PARTITION
    rows: list[tuple] = []

    def place(made: Iterator[list[Piece]]) -> None:
        nonlocal sequence
        for pieces in made:
            offset = 0
            for p in pieces:
                rows.append((p.doc_id, p.start, p.ids, p.doc_tokens, p.loss, sequence, offset))
                offset += len(p)
            sequence += 1

    def batch_of() -> pa.RecordBatch:
        kinds = [pa.binary() if name == "ids" else pa.int64() for name in names]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        rows.clear()
        return pa.RecordBatch.from_arrays(columns, names=names)

    names = [part.split()[0] for part in LAYOUT.split(", ")]
    for batch in batches:
        texts, keys, free = batch.column("text"), *(batch.column(c).to_pylist() for c in ("doc_id", "free"))
        for a, b in pieces_of(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), CHUNK):
            ids, stops = encoder.encode_array(texts.slice(a, b - a))
            raw, stops = ids.tobytes(), (4 * stops).tolist()
            for i, (start, stop) in enumerate(zip([0, *stops], stops, strict=False), a):
                size = (stop - start) // 4 + 1
                place(packer.add(Piece(keys[i], 0, raw[start:stop] + end, size, min(max(free[i], 0), size))))
            if rows:
                yield batch_of()
    place(packer.fill())
    if rows:
        yield batch_of()


def pack(
    docs: DataFrame,
    path: str,
    end_id: int = 0,
    limits: Limits = Limits(),
    free: str | None = None,
) -> DataFrame:
    """Pieces of all documents with their place: ``sequence_id`` and ``offset``.

    A document is its ids by the tokenizer of ``path`` and ``end_id``; ``start``
    and ``ids`` (little-endian unsigned 32-bit) say which part a piece is,
    ``loss_tokens`` how many of its ids bear loss. Every id is in one piece. ``free`` names a
    column with the number of a document's first ids that bear no loss, as those of
    a prompt; null, negative or without a column it is 0, and more than there are ids means all.
    Each input partition is packed by itself in one pass, so nothing is shuffled,
    a heavy source changes nothing, and a task that runs again makes the same
    sequences. A worker holds one batch and a pool of about ``POOL_TOKENS`` tokens.
    Padding is needed only where the limit of segments or of loss closes a sequence
    early; the last sequences of a partition have a power of two of tokens. A null or
    empty text is the end id alone; repeated rows are packed each; null ids stay
    null; no rows give no rows. Other columns of ``docs`` are not read.
    """
    masked = F.coalesce(F.col(free).cast("long"), F.lit(0)) if free else F.lit(0).cast("long")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), masked.alias("free")
    )
    return rows.mapInArrow(partial(_pack, path=path, end_id=end_id, limits=limits), LAYOUT)
