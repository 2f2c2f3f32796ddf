"""Exact search for the largest inner products: ball trees, branch and bound, by matrices.

Vectors are dealt into shards; each gets a tree of balls, written once. A search
task holds some blocks of queries and goes through some trees, one after the other.
In a tree, whole tiles of queries descend together; a leaf is multiplied with all
queries of a tile that it may still serve, and only what reaches a query's k-th
place is looked at. The k-th places go from tree to tree of a task. A first part of
the trees is searched before the others, whose tasks start from the k-th places
found there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwarden.llm.common import staged

# A tree has at most so many vectors, and about so many components.
SHARD = 65_536
VALUES = 1 << 22
BLOCK = 2048
LEAF = 256
# Queries that are multiplied with a leaf at once: products of both stay in a core's cache.
TILE = 1024
# One tree in so many is searched first.
FIRST = 16
# Components of queries that a search task holds at most, about.
HELD = 1 << 24
# Sums of products whose parts all stay below these are exact in floating point.
EXACT_SINGLE = float(1 << 24)
EXACT = float(1 << 53)
LOWEST, HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def integer_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """``vec_id`` and ``v``: floor(scale * x) of every component; one row per ``vec_id``.

    Vectors that are null or hold a null or non-finite component, and rows without
    an id, take no part. Of rows that repeat an id the smallest vector counts.
    A component whose multiple no BIGINT can hold is an error.
    """
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = rows.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(~bad)
    whole = F.transform(x, lambda c: F.floor(c * float(scale)).cast("long"))
    return (
        usable.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
        .groupBy("vec_id")
        .agg(F.min("v").alias("v"))
    )


def matrix(lists: pa.Array) -> np.ndarray:
    """Arrays of one length as a matrix."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(lists), -1) if len(lists) else np.empty((0, 0), np.int64)


def narrowed(whole: np.ndarray) -> tuple[str, bytes]:
    """The smallest kind of integer that holds all values, and the values so."""
    least, most = int(whole.min(initial=0)), int(whole.max(initial=0))
    kind = next(c for c in "bhiq" if np.iinfo(c).min <= least and most <= np.iinfo(c).max)
    return kind, np.ascontiguousarray(whole, kind).tobytes()


def lengths(floats: np.ndarray) -> np.ndarray:
    return np.sqrt((floats**2).sum(axis=1))


class Queries:
    """Queries of one length and the best ``k`` found of each so far, best first.

    ``floor`` and ``floor_ids`` are a score and an id that are known to be as good as
    the k-th of each query: what comes after these is not looked for. Places that are
    not filled have the lowest score.
    """

    def __init__(self, ids, vectors, k: int, floor, floor_ids=None):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.scores = np.full((len(ids), k), LOWEST)
        self.found = np.full((len(ids), k), HIGHEST)
        self.kth = np.array(floor, np.int64)
        self.kth_ids = np.full(len(ids), HIGHEST) if floor_ids is None else np.array(floor_ids, np.int64)

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Merge candidates, given by the query's row, with those found."""
        touched, place = np.unique(rows, return_inverse=True)
        groups = np.concatenate([np.repeat(np.arange(len(touched)), self.k), place])
        all_scores = np.concatenate([self.scores[touched].ravel(), scores])
        all_ids = np.concatenate([self.found[touched].ravel(), ids])
        # The larger score first, then the smaller id.
        order = np.lexsort((all_ids, ~all_scores, groups))
        starts = np.searchsorted(groups[order], np.arange(len(touched)))
        order = order[starts[:, None] + np.arange(self.k)]
        self.scores[touched], self.found[touched] = all_scores[order], all_ids[order]
        last, last_ids = all_scores[order[:, -1]], all_ids[order[:, -1]]
        known, known_ids = self.kth[touched], self.kth_ids[touched]
        better = (last > known) | ((last == known) & (last_ids < known_ids))
        self.kth[touched] = np.where(better, last, known)
        self.kth_ids[touched] = np.where(better, last_ids, known_ids)


class BallTree:
    """Nodes as arrays; a leaf's vectors are the rows from ``low`` to ``high``, by id."""

    def __init__(self, ids, vectors, low, high, left, centre, radius):
        self.ids, self.vectors = ids, vectors
        self.low, self.high, self.left = low, high, left
        self.centre, self.radius = centre, radius
        self.centre_length = lengths(centre)
        # The longest vector of each node, a little more to cover rounding.
        self.longest = (self.centre_length + radius) * (1 + 1e-9)
        self.singles = None

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray) -> BallTree:
        """Split along the line between two far vectors, at the median, down to leaves."""
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        floats = vectors.astype(np.float64)
        seats = np.arange(len(ids))
        low, high, left, centres, radii = [0], [len(ids)], [-1], [], []
        node = 0
        while node < len(low):
            a, b = low[node], high[node]
            own = floats[seats[a:b]]
            centre = own.mean(axis=0)
            apart = ((own - centre) ** 2).sum(axis=1)
            centres.append(centre)
            # A little more than the radius covers rounding.
            radius = math.sqrt(float(apart.max()))
            radii.append(radius * (1 + 1e-9) + 1e-6 + 1e-12 * math.sqrt(float((centre**2).sum())))
            if b - a > LEAF and apart.max() > 0:
                far = own[np.argmax(apart)]
                other = own[np.argmax(((own - far) ** 2).sum(axis=1))]
                along = np.argsort(own @ (other - far), kind="stable")
                seats[a:b] = seats[a:b][along]
                middle = (a + b) // 2
                left[node] = len(low)
                low += [a, middle]
                high += [middle, b]
                left += [-1, -1]
            else:
                seats[a:b] = np.sort(seats[a:b])
            node += 1
        return cls(
            ids[seats],
            vectors[seats],
            np.array(low),
            np.array(high),
            np.array(left),
            np.array(centres),
            np.array(radii),
        )

    PARTS = ("ids", "low", "high", "left", "centre", "radius")
    LAYOUT = "kind string, vectors binary, ids binary, low binary, high binary, left binary, centre binary, radius binary"

    def pack(self) -> dict[str, str | bytes]:
        kind, vectors = narrowed(self.vectors)
        parts = {p: np.ascontiguousarray(getattr(self, p)).tobytes() for p in self.PARTS}
        return {"kind": kind, "vectors": vectors, **parts}

    @classmethod
    def unpack(cls, row: dict, dim: int) -> BallTree:
        kinds = dict(zip(cls.PARTS, "qqqqdd", strict=True))
        found = {p: np.frombuffer(row[p], kinds[p]) for p in cls.PARTS}
        found["vectors"] = np.frombuffer(row["vectors"], row["kind"]).reshape(-1, dim)
        found["centre"] = found["centre"].reshape(-1, dim)
        return cls(**found)

    def limits(self, nodes: np.ndarray, floats: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The largest inner product with each query (column) that each node (row) can hold."""
        limit = self.centre[nodes] @ floats.T
        limit += np.outer(self.radius[nodes], length)
        # Rounding of the sums above.
        limit += np.outer(1e-9 * self.longest[nodes], length) + 1e-6
        return limit

    def leaves(self, floats: np.ndarray, length: np.ndarray, kth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaves that may serve one of the queries, and their limits."""
        nodes, leaves, limits = np.array([0]), [], []
        while len(nodes):
            limit = self.limits(nodes, floats, length)
            reached = (limit >= kth).any(axis=1)
            ends = reached & (self.left[nodes] < 0)
            leaves.append(nodes[ends])
            limits.append(limit[ends])
            inner = self.left[nodes[reached & ~ends]]
            nodes = np.concatenate([inner, inner + 1])
        return np.concatenate(leaves), np.concatenate(limits)

    def products(self, queries: np.ndarray, low: int, high: int, largest: float, out: np.ndarray) -> np.ndarray:
        """Exact inner products of a leaf's vectors (rows) and queries (columns).

        ``largest`` is a bound of what lengths make possible; parts of the sums do not
        exceed it, so that floating point numbers of few digits are exact below theirs.
        """
        if largest < EXACT_SINGLE:
            if self.singles is None:
                self.singles = self.vectors.astype(np.float32)
            made = out[: (high - low) * len(queries)].reshape(high - low, -1)
            return np.matmul(self.singles[low:high], queries.astype(np.float32, copy=False).T, out=made)
        own = self.vectors[low:high]
        if largest < EXACT:
            return own.astype(np.float64) @ queries.astype(np.float64).T
        exact = own.astype(object) @ queries.astype(object).T
        if exact.size and max(abs(int(exact.max())), abs(int(exact.min()))) >= 1 << 63:
            raise OverflowError("an inner product is too large for a BIGINT")
        return exact.astype(np.int64)

    def go_through(self, asked: Queries) -> None:
        """Add what this tree holds to the best of all queries."""
        out = np.empty(TILE * LEAF, np.float32)
        for start in range(0, len(asked.ids), TILE):
            self._tile(asked, np.arange(start, min(start + TILE, len(asked.ids))), out)

    def _tile(self, asked: Queries, tile: np.ndarray, out: np.ndarray) -> None:
        vectors = asked.vectors[tile[0] : tile[-1] + 1]
        floats = vectors.astype(np.float64)
        length = lengths(floats)
        longest = float(length.max())
        # Only numbers below the limit are multiplied so, and these are exact.
        singles = floats.astype(np.float32) if longest < EXACT_SINGLE else None
        leaves, limits = self.leaves(floats, length, asked.kth[tile].astype(np.float64))
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def merge(least: int) -> None:
            if sum(len(rows) for rows, _, _ in waiting) >= least:
                asked.add(*(np.concatenate(parts) for parts in zip(*waiting, strict=True)))
                waiting.clear()

        def multiply(leaf: int, rows: np.ndarray) -> None:
            low, high = self.low[leaf], self.high[leaf]
            if high - low > LEAF:
                # All are one vector: only the smallest ids count, and the query's own may be one.
                high = low + min(high - low, asked.k + 1)
            bound = longest * float(self.longest[leaf])
            part = singles if bound < EXACT_SINGLE else vectors
            for a in range(low, high, LEAF):
                b = min(a + LEAF, high)
                made = self.products(part if len(rows) == len(tile) else part[rows], a, b, bound, out)
                kth = asked.kth[tile[rows]].astype(made.dtype)
                hit = np.flatnonzero(made.max(axis=0) >= kth)
                if not len(hit):
                    continue
                made, least = made[:, hit], kth[hit]
                if b - a > asked.k + 1:
                    # Of what is in this leaf, k and the query's own vector at most.
                    least = np.maximum(least, np.partition(made, -asked.k - 1, axis=0)[-asked.k - 1])
                places, columns = np.nonzero(made >= least)
                ids, who = self.ids[a + places], tile[rows[hit[columns]]]
                scores = np.asarray(made[places, columns]).astype(np.int64)
                better = (scores > asked.kth[who]) | ((scores == asked.kth[who]) & (ids < asked.kth_ids[who]))
                better &= ids != asked.ids[who]
                if better.any():
                    waiting.append((who[better], ids[better], scores[better]))
                    merge(1 + len(tile) // 4)

        everyone = np.arange(len(tile))
        # Queries without any k-th place begin with the leaf that promises most.
        bare = np.flatnonzero(asked.kth[tile] == LOWEST) if len(leaves) > 1 else everyone[:0]
        if len(bare):
            best = limits[:, bare].argmax(axis=0)
            for leaf in np.unique(best):
                rows = bare[best == leaf]
                multiply(leaves[leaf], rows)
                limits[leaf, rows] = -np.inf
            merge(1)
        for leaf in np.argsort(-limits.max(axis=1, initial=-np.inf), kind="stable"):
            rows = np.flatnonzero(limits[leaf] >= asked.kth[tile])
            if len(rows):
                multiply(leaves[leaf], rows)
        merge(1)

    def search(
        self, ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each query's best ``k`` scores, their ids and which places are filled.

        ``floor`` has the k-th score that is known of each query: what scores
        less is not looked for.
        """
        asked = Queries(ids, queries, k, floor)
        self.go_through(asked)
        return asked.scores, asked.found, asked.scores > LOWEST


def _trees(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    shard, dim = (k.as_py() for k in key)
    vectors = matrix(table.column("v").combine_chunks())
    tree = BallTree.build(table.column("vec_id").to_numpy(), vectors)
    return pa.Table.from_pylist(
        [{"shard": shard, "dim": dim, **tree.pack()}],
        schema=pa.schema(
            [
                ("shard", pa.int32()),
                ("dim", pa.int32()),
                ("kind", pa.string()),
                ("vectors", pa.binary()),
                *[(p, pa.binary()) for p in BallTree.PARTS],
            ]
        ),
    )


BLOCKS = "block int, dim int, kind string, vectors binary, ids binary, floor binary, floor_ids binary"


def _blocks(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    block, dim = (x.as_py() for x in key)
    kind, vectors = narrowed(matrix(table.column("v").combine_chunks()))
    whole = {"ids": "vec_id", "floor": "floor", "floor_ids": "floor_id"}
    return pa.Table.from_pydict(
        {
            "block": pa.array([block], pa.int32()),
            "dim": pa.array([dim], pa.int32()),
            "kind": [kind],
            "vectors": [vectors],
            **{name: [table.column(c).to_numpy().astype(np.int64).tobytes()] for name, c in whole.items()},
        }
    )


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Blocks of queries come first, then trees."""
    blocks: dict[int, list[dict]] = {}
    asked: dict[int, Queries] = {}
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            dim = row["dim"]
            if row["shard"] is None:
                blocks.setdefault(dim, []).append(row)
                continue
            if dim in blocks:
                own = blocks.pop(dim)
                whole = (np.concatenate([np.frombuffer(x[p], "q") for x in own]) for p in ("ids", "floor", "floor_ids"))
                ids, floor, floor_ids = whole
                vectors = np.concatenate([np.frombuffer(x["vectors"], x["kind"]).reshape(-1, dim) for x in own])
                asked[dim] = Queries(ids, vectors, k, floor, floor_ids)
            if dim in asked:
                BallTree.unpack(row, dim).go_through(asked[dim])
    for q in asked.values():
        rows, places = np.nonzero(q.scores > LOWEST)
        found = {"query_id": q.ids[rows], "vec_id": q.found[rows, places], "score": q.scores[rows, places]}
        yield pa.RecordBatch.from_pydict(found)


def grid(rows: int, asked: int, trees: int, blocks: int, values: int) -> tuple[int, int]:
    """Into how many groups trees and blocks of queries go; a task takes one of each.

    Tasks grow with the root of the number of pairs, and what is sent to them, each
    tree once per group of blocks and the other way round, is least in this shape.
    """
    pairs = rows * asked
    tasks = max(math.ceil(math.sqrt(pairs) / 8192), min(48, math.ceil(pairs / (1 << 22))))
    a = min(trees, max(1, round(math.sqrt(tasks * rows / max(1, asked)))))
    return a, max(1, min(blocks, max(math.ceil(tasks / a), math.ceil(values / HELD))))


def top_products(
    vectors: DataFrame, queries: DataFrame, folder: str, k: int = 5, shard: int = SHARD, block: int = BLOCK
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` largest inner products.

    Both inputs have ``vec_id`` and ``v`` (array of BIGINT), an id once. A query's
    own id is no candidate; ties go to the smaller id; where there are fewer than
    ``k`` candidates there are fewer rows. Vectors are compared with those of the
    same length. A tree and a block have at most about the given number of rows
    whatever the input; every block meets every tree once, in independent tasks that
    hold a group of blocks and one tree at a time.
    """
    dim = F.size("v")
    counted = [F.count(F.lit(1)), F.coalesce(F.sum(dim), F.lit(0))]
    many, values = vectors.agg(*counted).first()
    many_asked, asked_values = queries.agg(*counted).first()
    shards = max(1, math.ceil(many / shard), math.ceil(values / VALUES), min(16, math.ceil(many / 4096)))
    blocks = max(1, math.ceil(many_asked / block), min(16, math.ceil(many_asked / 64)))
    dealt = vectors.where(dim > 0).select(
        F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"),
        dim.alias("dim"),
        "vec_id",
        "v",
    )
    trees = dealt.groupBy("shard", "dim").applyInArrow(
        _trees, f"shard int, dim int, {BallTree.LAYOUT}"
    )
    trees = staged(trees, f"{folder}/trees")
    asked = queries.where(dim > 0).select(
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"),
        dim.alias("dim"),
        "vec_id",
        "v",
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def searched(low: int, high: int, floors: DataFrame) -> DataFrame:
        """What trees of the shards from ``low`` to ``high`` hold above the floors."""
        a, b = grid(many * (high - low) // shards, many_asked, high - low, blocks, asked_values)
        packed = floors.groupBy("block", "dim").applyInArrow(_blocks, BLOCKS)
        own = F.pmod("block", F.lit(b)) * a
        sent = packed.withColumn("task", F.explode(F.sequence(own, own + a - 1))).drop("block")
        group = F.pmod("shard", F.lit(a))
        of = F.transform(F.sequence(F.lit(0), F.lit(b - 1)), lambda i: i * a + group)
        met = trees.where(F.col("shard").between(low, high - 1)).withColumn("task", F.explode(of))
        both = sent.unionByName(met, allowMissingColumns=True).repartitionById(a * b, F.col("task").cast("int"))
        found = both.sortWithinPartitions(F.asc_nulls_first("shard")).mapInArrow(
            partial(_search, k=k), "query_id long, vec_id long, score long"
        )
        return found

    def ranked(found: DataFrame) -> DataFrame:
        placed = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        return placed.select("query_id", "rank", "vec_id", "score")

    first = math.ceil(shards / FIRST)
    none = asked.withColumns({"floor": F.lit(int(LOWEST)), "floor_id": F.lit(int(HIGHEST))})
    found = ranked(searched(0, first, none))
    if first == shards:
        return found
    found = staged(found, f"{folder}/first")
    known = found.where(F.col("rank") == k).select(
        F.col("query_id").alias("vec_id"), F.col("score").alias("floor"), F.col("vec_id").alias("floor_id")
    )
    floors = asked.join(known, "vec_id", "left").fillna({"floor": int(LOWEST), "floor_id": int(HIGHEST)})
    return ranked(found.drop("rank").unionByName(searched(first, shards, floors)))


ORACLE = """
WITH usable AS (
    SELECT vec_id, min([CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding]) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    GROUP BY vec_id
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
        CAST(list_sum([a[1] * a[2] FOR a IN list_zip(q.v, c.v)]) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
    WHERE q.vec_id % 50 = 0 AND len(q.v) > 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
