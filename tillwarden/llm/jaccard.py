"""N-gram Jaccard join: texts whose sets of word shingles overlap enough, and their groups.

Equal sets are one node from the start. Two sets can only link if they share a
token among the first few of each, in any one order of all tokens (the prefix);
the order puts tokens that a sample shows to be common last, so that prefixes
hold rare ones. Prefixes are taken about twice as long as that needs, so that sets
that link share many of their tokens: a node needs as many that others hold too,
by counts over all nodes, and only its rarest ones beyond these have to be looked
at. Nodes that share such a token are joined by a signature tree:
its nodes hold the OR of their members' bitmaps and the range of their sizes, and
pairs of tree nodes are dropped when no two members can overlap enough. What the
bitmaps leave is compared exactly, skipping nodes that are already linked.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwarden.llm.common import hint_if_small, pieces_of, staged, texts_of

CHUNK = 1 << 20
LEAF = 32
SMALLEST_BITMAP = 256
LARGEST_BITMAP = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


@dataclass(frozen=True)
class JoinRules:
    """Sets of ``shingle`` words link from ``percent`` of their union on.

    ``sample`` documents show which tokens are common, ``common`` bounds how many
    are kept: both bear on speed alone, any order of tokens gives the same links.
    So does ``longer``, by what percentage of the tokens that a set may lack more of
    them are looked at: more rule out more nodes, and are more to count.
    A task joins at most two blocks of ``block`` nodes.
    """

    shingle: int = 3
    percent: int = 90
    sample: int = 10_000
    common: int = 400_000
    longer: int = 100
    block: int = 1024

    def least(self, n: int) -> int:
        """The size of the smallest set that one of ``n`` can link to; they overlap by as much."""
        return -(-self.percent * n // 100)

    def prefix(self, n: int) -> int:
        """How many first tokens a set of ``n`` must share one of with any set it links to."""
        return n - self.least(n) + 1

    def extra(self, n: int) -> int:
        """How many more tokens are looked at; as many more are then shared."""
        return min(self.longer * (n - self.least(n)) // 100, self.least(n) - 1)

    def spare(self, n: int) -> int:
        """One less than what a set of ``n`` surely shares, in longer prefixes, with any it links to.

        The smaller of two sets has the smaller ``extra``. Of its tokens that other
        prefixes hold, a set need not be looked up by the last ``spare``, in any one
        order of tokens; if it has no more than these, it links to nothing.
        """
        return self.extra(self.least(n))

    def enough(self, overlap, a, b):
        """Whether an overlap of sets of sizes ``a`` and ``b`` makes a link."""
        return (100 + self.percent) * overlap >= self.percent * (a + b)


# Shingles.


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (a fixed public finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    up, down = (np.full(size, b, np.uint64) for b in (BASE, inverse))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """The distinct hashed shingles of each text, ascending; words of ASCII-lowered text.

    All words of all texts are hashed at once: a word's hash is the difference of
    two running sums over its bytes. A text of fewer words is one shingle.
    """
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    upper = (data >= 65) & (data <= 90)
    data = np.where(upper, data + 32, data)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    inside = np.concatenate([[False], ~blank])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = powers(1 << max(20, len(data).bit_length()))
    with np.errstate(over="ignore"):
        running = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
        words = _mixed((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        offsets = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
        cuts = np.searchsorted(starts, offsets)
        joined = np.zeros(len(words), np.uint64)
        for k in range(size):
            shifted = words[k:] if k else words
            joined[: len(shifted)] = _mixed(joined[: len(shifted)] * np.uint64(31) + shifted)
        sets = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a >= size:
                sets.append(np.unique(joined[a : b - size + 1]))
            elif b > a:
                one = np.uint64(b - a)
                for w in words[a:b]:
                    one = _mixed(np.array([one * np.uint64(31) + w]))[0]
                sets.append(np.array([one], np.uint64))
            else:
                sets.append(np.empty(0, np.uint64))
    return sets


def node_of(tokens: np.ndarray) -> bytes:
    return blake2b(tokens.tobytes(), digest_size=16).digest()


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """One bit per token, by its low bits; at least two bits of room per token."""
    bits = SMALLEST_BITMAP
    while bits < 2 * len(tokens) and bits < LARGEST_BITMAP:
        bits *= 2
    flags = np.zeros(bits, np.uint8)
    flags[(tokens & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """A bitmap at a smaller size: halves are OR-combined, as low bits decide places."""
    return np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


# Signature trees.


class Tree:
    """Members sorted by size; each tree node has a range of sizes and an OR of bitmaps.

    A set with n tokens that sets b bits has n - b tokens that share a bit with
    others, its excess. Two sets share at most the bits both have plus either excess.
    """

    def __init__(self, sizes: np.ndarray, bitmaps: list[np.ndarray], order: np.ndarray):
        self.order = order
        self.sizes = sizes[order]
        self.bitmaps = [bitmaps[i] for i in order]
        self.nodes: list[tuple[int, int, np.ndarray, int, tuple[int, ...]]] = []
        self.root = self._build(0, len(order))

    def _build(self, low: int, high: int) -> int:
        children: tuple[int, ...] = ()
        if high - low > LEAF:
            middle = (low + high) // 2
            children = (self._build(low, middle), self._build(middle, high))
        words = min(len(b) for b in self.bitmaps[low:high])
        own = self.leaf(low, high, words)
        excess = self.sizes[low:high] - np.bitwise_count(own).sum(axis=1, dtype=np.int64)
        together = np.bitwise_or.reduce(own, axis=0)
        self.nodes.append((low, high, together, int(excess.max()), children))
        return len(self.nodes) - 1

    def leaf(self, low: int, high: int, words: int) -> np.ndarray:
        return np.array([folded(b, words) for b in self.bitmaps[low:high]])


def leaf_pairs(
    one: Tree, other: Tree, rules: JoinRules, joined: Joined | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Member pairs that may overlap enough, leaf by leaf, with the overlap's bound.

    Both trees are walked together. A pair of tree nodes is dropped if its sizes
    are too far apart or its common bits, with the smaller excess, too few. At two
    resolutions of bitmaps only the sizes are used; sets that link differ little
    in size, so that is rare. Members that are ``joined`` already are passed over,
    whole tree nodes at a time where they can be.
    """
    same = one is other
    waiting = [(one.root, other.root)]
    while waiting:
        x, y = waiting.pop()
        low, high, bits, excess, children = one.nodes[x]
        low2, high2, bits2, excess2, children2 = other.nodes[y]
        limit = min(one.sizes[high - 1], other.sizes[high2 - 1])
        if len(bits) == len(bits2):
            common = int(np.bitwise_count(bits & bits2).sum())
            limit = min(limit, common + min(excess, excess2))
        if not rules.enough(limit, one.sizes[low], other.sizes[low2]):
            continue
        if joined and joined.all_one(one.order[low:high], other.order[low2:high2]):
            continue
        if same and x == y and children:
            first, second = children
            waiting += [(first, first), (second, second), (first, second)]
        elif children and (not children2 or high - low >= high2 - low2):
            waiting += [(c, y) for c in children]
        elif children2:
            waiting += [(x, c) for c in children2]
        else:
            words = min(len(bits), len(bits2))
            mine, theirs = one.leaf(low, high, words), other.leaf(low2, high2, words)
            both = np.bitwise_count(mine[:, None, :] & theirs[None, :, :]).sum(axis=2, dtype=np.int64)
            a, b = one.sizes[low:high][:, None], other.sizes[low2:high2][None, :]
            # Every bit of a set that the other lacks stands for a token it lacks.
            lacks = np.bitwise_count(mine).sum(axis=1, dtype=np.int64)[:, None] - both
            lacks2 = np.bitwise_count(theirs).sum(axis=1, dtype=np.int64)[None, :] - both
            limits = np.minimum(a - lacks, b - lacks2)
            may = rules.enough(limits, a, b)
            if same and x == y:
                may &= np.arange(high - low)[:, None] < np.arange(high2 - low2)[None, :]
            i, j = np.nonzero(may)
            if len(i):
                yield one.order[low + i], other.order[low2 + j], limits[i, j]


class Joined:
    """Which members are connected: those of one number."""

    def __init__(self, size: int):
        self.number = np.arange(size)

    def all_one(self, a: np.ndarray, b: np.ndarray) -> bool:
        mine, theirs = self.number[a], self.number[b]
        return bool((mine == mine[0]).all() and (theirs == mine[0]).all())

    def apart(self, a, b):
        return self.number[a] != self.number[b]

    def join(self, a: int, b: int) -> None:
        self.number[self.number == self.number[b]] = self.number[a]


def trees_of(sizes: np.ndarray, bitmaps, sides: np.ndarray) -> list[tuple[Tree, Tree]]:
    """One tree for a block with itself, two for a pair of blocks."""
    order = np.argsort(sizes, kind="stable")
    if not sides.any():
        tree = Tree(sizes, bitmaps, order)
        return [(tree, tree)]
    first, second = (order[sides[order] == s] for s in (0, 1))
    if not len(first):
        return []
    return [(Tree(sizes, bitmaps, first), Tree(sizes, bitmaps, second))]


def may_link(sizes: np.ndarray, bitmaps, sides: np.ndarray, rules: JoinRules) -> list[tuple[int, int]]:
    """Pairs that connect all members whose sizes and bitmaps do not rule a link out."""
    ordered = np.sort(sizes)
    if not rules.enough(ordered[:-1], ordered[:-1], ordered[1:]).any():
        return []
    joined, made = Joined(len(sizes)), []
    for one, other in trees_of(sizes, bitmaps, sides):
        for i, j, _ in leaf_pairs(one, other, rules, joined):
            apart = joined.apart(i, j)
            while apart.any():
                i, j = i[apart], j[apart]
                made.append((int(i[0]), int(j[0])))
                joined.join(i[0], j[0])
                apart = joined.apart(i, j)
    return made


def links(tokens: list[np.ndarray], sides: np.ndarray, rules: JoinRules) -> list[tuple[int, int]]:
    """Links that connect what the block's links connect, without those inside a group.

    Pairs of a leaf are compared with the largest bound first; a pair that is
    connected already is not compared.
    """
    sizes = np.array([len(t) for t in tokens])
    joined, made = Joined(len(tokens)), []
    for one, other in trees_of(sizes, [bitmap(t) for t in tokens], sides):
        for i, j, limit in leaf_pairs(one, other, rules, joined):
            for p in np.argsort(-limit, kind="stable"):
                a, b = int(i[p]), int(j[p])
                if not joined.apart(a, b):
                    continue
                overlap = len(np.intersect1d(tokens[a], tokens[b], assume_unique=True))
                if rules.enough(overlap, sizes[a], sizes[b]):
                    joined.join(a, b)
                    made.append((a, b))
    return made


# Steps that run in tasks.


def _common_tokens(batches: Iterator[pa.RecordBatch], rules: JoinRules) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch)
        for a, b in pieces_of([len(t) for t in texts], CHUNK):
            found = np.concatenate([s for s in shingle_sets(texts[a:b], rules.shingle)])
            token, times = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_pydict({"token": token.view(np.int64), "times": times})


def _names(batches: Iterator[pa.RecordBatch], rules: JoinRules) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch)
        for a, b in pieces_of([len(t) for t in texts], CHUNK):
            sets = shingle_sets(texts[a:b], rules.shingle)
            rows = batch.select(["doc_id", "own"]).slice(a, b - a)
            nodes = pa.array([node_of(t) if len(t) else None for t in sets], pa.binary())
            counts = pa.array([len(t) for t in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, counts, nodes], names=["doc_id", "own", "n", "node"]
            )


def _sketch(
    batches: Iterator[pa.RecordBatch], rules: JoinRules, common: Broadcast
) -> Iterator[pa.RecordBatch]:
    usual, rank = common.value
    usual = usual.view(np.uint64)
    for batch in batches:
        texts, keys = texts_of(batch), batch.column("doc_id")
        for a, b in pieces_of([len(t) for t in texts], CHUNK):
            nodes, counts, spare, prefixes, bitmaps = [], [], [], [], []
            for tokens in shingle_sets(texts[a:b], rules.shingle):
                counts.append(len(tokens))
                if not len(tokens):
                    nodes.append(None), spare.append(None), prefixes.append(None), bitmaps.append(None)
                    continue
                nodes.append(node_of(tokens))
                spare.append(rules.spare(len(tokens)))
                most = rules.prefix(len(tokens)) + rules.extra(len(tokens))
                if len(usual):
                    at = np.minimum(np.searchsorted(usual, tokens), len(usual) - 1)
                    order = np.where(usual[at] == tokens, rank[at], 0)
                    first = tokens[np.argsort(order, kind="stable")[:most]]
                else:
                    first = tokens[:most]
                prefixes.append(first.view(np.int64))
                bitmaps.append(bitmap(tokens).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    keys.slice(a, b - a),
                    batch.column("own").slice(a, b - a),
                    pa.array(counts, pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.array(spare, pa.int64()),
                    pa.array(prefixes, pa.list_(pa.int64())),
                    pa.array(bitmaps, pa.binary()),
                ],
                names=["doc_id", "own", "n", "node", "spare", "prefix", "bits"],
            )


PLACE = ["key", "one", "other", "block", "seat"]


def _member_texts(batches: Iterator[pa.RecordBatch], rules: JoinRules) -> Iterator[pa.RecordBatch]:
    """The texts of members, where they are to be compared; copies in a task once.

    A text is sent, not its tokens: it is smaller, and it compresses.
    """
    made = set()
    for batch in batches:
        texts, nodes = texts_of(batch), batch.column("node").to_pylist()
        places = list(zip(*[batch.column(c).to_pylist() for c in PLACE], strict=True))
        for a, b in pieces_of([len(t) for t in texts], CHUNK):
            rows = []
            for i, tokens in enumerate(shingle_sets(texts[a:b], rules.shingle), a):
                # Another text of the same id is another node.
                if places[i] not in made and len(tokens) and node_of(tokens) == nodes[i]:
                    made.add(places[i])
                    rows.append(i)
            if rows:
                yield batch.select([*PLACE, "text"]).take(pa.array(rows))


def _token_sets(batches: Iterator[pa.RecordBatch], rules: JoinRules) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch)
        for a, b in pieces_of([len(t) for t in texts], CHUNK):
            sets = pa.array([t.tobytes() for t in shingle_sets(texts[a:b], rules.shingle)], pa.binary())
            places = batch.select(PLACE).slice(a, b - a)
            yield pa.RecordBatch.from_arrays([*places.columns, sets], names=[*PLACE, "tokens"])


def _groups(
    batches: Iterator[pa.RecordBatch], names: list[str]
) -> Iterator[tuple[np.ndarray, dict[str, list]]]:
    """Runs of rows of one key and block pair, of partitions sorted by them.

    With each comes 0 for members of the first block of the pair, 1 for those of
    the second.
    """

    def made() -> tuple[np.ndarray, dict[str, list]]:
        return (np.array(held["block"]) != key[1]).astype(np.int64), held

    held, key = defaultdict(list), None
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("key", "one", "other", "block", *names)]
        for row in zip(*columns, strict=True):
            if row[:3] != key:
                if key is not None:
                    yield made()
                held, key = defaultdict(list), row[:3]
            for name, value in zip(("block", *names), row[3:], strict=True):
                held[name].append(value)
    if key is not None:
        yield made()


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())}
    )


def _light(batches: Iterator[pa.RecordBatch], rules: JoinRules) -> Iterator[pa.RecordBatch]:
    found: list[tuple[int, int]] = []
    for sides, group in _groups(batches, ["seat", "n", "bits"]):
        bitmaps = [np.frombuffer(b, np.uint64) for b in group["bits"]]
        pairs = may_link(np.array(group["n"]), bitmaps, sides, rules)
        found += [(group["seat"][i], group["seat"][j]) for i, j in pairs]
        if len(found) > 10_000:
            yield _edges(found)
            found = []
    if found:
        yield _edges(found)


def _exact(batches: Iterator[pa.RecordBatch], rules: JoinRules) -> Iterator[pa.RecordBatch]:
    for sides, group in _groups(_token_sets(batches, rules), ["seat", "tokens"]):
        seats, first = np.unique(group["seat"], return_index=True)
        sets = [np.frombuffer(group["tokens"][i], np.uint64) for i in first]
        made = links(sets, sides[first], rules)
        if made:
            yield _edges([(int(seats[i]), int(seats[j])) for i, j in made])


# The join.


def common_tokens(docs: DataFrame, rules: JoinRules) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that come twice or more in a sample of the documents, and how often.

    The sample is the documents with the smallest hashes, as many as the rules
    say on average, so it does not grow with the input.
    """
    many = docs.count()
    turn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    share = min(1.0, rules.sample / max(many, 1))
    sample = docs.where(turn < int(share * (1 << 30))).select("text")
    times = sample.mapInArrow(partial(_common_tokens, rules=rules), "token long, times long")
    usual = (
        times.groupBy("token")
        .agg(F.sum("times").alias("times"))
        .where("times > 1")
        .orderBy(F.desc("times"), "token")
        .limit(rules.common)
    )
    found = usual.toPandas()
    tokens = found["token"].to_numpy(np.int64)
    order = np.argsort(tokens.view(np.uint64))
    return tokens[order], found["times"].to_numpy(np.int64)[order]


def with_held(entries: DataFrame) -> DataFrame:
    """Entries whose ``key`` several have, and how many: ``held``."""
    held = entries.groupBy("key").agg(F.count("*").alias("held")).where("held > 1")
    return entries.join(held, "key")


def in_blocks(entries: DataFrame, rules: JoinRules) -> DataFrame:
    """Entries of a ``key`` with more than a block of nodes go to every pair of its blocks.

    ``held`` is the number of nodes of the key. Each pair of blocks is a group
    of bounded size of its own, ``one <= other``.
    """
    blocks = F.ceil(F.col("held") / rules.block).cast("int")
    own = F.pmod(F.xxhash64("seat"), blocks).cast("int")
    rows = entries.withColumn("blocks", blocks).withColumn("block", own)
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumns(
        {"one": F.least("block", "with"), "other": F.greatest("block", "with")}
    ).drop("blocks", "with", "held")


def _by_group(rows: DataFrame) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["key", "one", "other"]
    return rows.repartition(parts, *keys).sortWithinPartitions(*keys)


def components(edges: DataFrame, folder: str) -> DataFrame:
    """``seat`` and ``label`` (the smallest seat it is connected to) of every linked node.

    Each round hangs the larger neighbours of every node on its smallest one, and
    then all others; trees get flat in a number of rounds that grows with the
    logarithm of their size. Rounds are written to the shared folder.
    """
    edges = staged(edges.where("a <> b").select("a", "b").distinct(), f"{folder}/edges")
    before = None
    step = 0
    while True:
        # Larger neighbours hang on the smallest neighbour.
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.where("a <> b").distinct(), f"{folder}/large{step}")
        # Smaller neighbours hang on the smallest of them.
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        hung = down.join(least, "a").select(F.col("b").alias("x"), "m")
        small = hung.where("x <> m").select(F.col("x").alias("a"), F.col("m").alias("b"))
        small = small.union(least.select("a", F.col("m").alias("b"))).distinct()
        edges = staged(small, f"{folder}/small{step}")
        step += 1
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("seat"), F.col("b").alias("label"))


def jaccard_join(docs: DataFrame, folder: str, rules: JoinRules = JoinRules()) -> DataFrame:
    """``doc_id, own, n_shingles, component_id, node, label`` of every row.

    ``own`` is a hash of the row's text, ``node`` names the set of a row, ``label`` its group; ``component_id`` is the
    smallest ``doc_id`` of the group, links being followed. Rows without words
    have no set: they link with nothing, and their own id is their component. So
    is null for rows without an id, unless their group has one. Rows alike in text
    are one node, however many they are. Other columns of ``docs`` are not read.
    No rows give no rows. Intermediate tables are written to ``folder``.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    common = spark.sparkContext.broadcast(common_tokens(docs, rules))
    # Texts are hashed twice: what is known of a row is kept, prefixes only of nodes.
    hashed = docs.withColumn("own", F.xxhash64("text"))
    named = hashed.mapInArrow(
        partial(_names, rules=rules), "doc_id long, own long, n long, node binary"
    )
    found = staged(named, f"{folder}/found")
    sketch = hashed.mapInArrow(
        partial(_sketch, rules=rules, common=common),
        "doc_id long, own long, n long, node binary, spare long, prefix array<long>, bits binary",
    )
    nodes = (
        sketch.where("node is not null")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("least"),
            F.coalesce(F.min_by("own", "doc_id"), F.min("own")).alias("text"),
            F.first("n").alias("n"),
            F.first("spare").alias("spare"),
            F.first("prefix").alias("prefix"),
            F.first("bits").alias("bits"),
        )
    )
    # A number is less to send than a node's name; it is written with the node.
    nodes = staged(nodes.withColumn("seat", F.monotonically_increasing_id()), f"{folder}/nodes")

    entries = nodes.select("seat", F.explode("prefix").alias("key"))
    shared = with_held(entries).join(nodes.select("seat", "n", "spare"), "seat")
    own = Window.partitionBy("seat")
    ranked = shared.withColumns(
        {"many": F.count("*").over(own), "place": F.row_number().over(own.orderBy("held", "key"))}
    )
    rarest = staged(ranked.where("place <= many - spare").select("seat", "n", "key"), f"{folder}/rarest")
    shared = staged(with_held(rarest), f"{folder}/shared")
    # Tokens held by the same nodes (those of a passage, of a pair of copies) are one
    # group: the least of them stands for all. The names of node sets have 128 bits.
    sets = shared.groupBy("key").agg(
        F.first("held").alias("held"),
        F.bit_xor(F.xxhash64("seat")).alias("one"),
        F.bit_xor(F.xxhash64("seat", F.lit(1))).alias("other"),
    )
    standing = sets.groupBy("held", "one", "other").agg(F.min("key").alias("key")).select("key")
    shared = shared.join(standing, "key", "left_semi")
    # Only nodes in a shared token's group carry their bitmap on, and of groups of
    # one block only those with a neighbour of nearly their size.
    lone = F.when(F.col("held") > rules.block, F.col("seat")).otherwise(-1)
    by_size = Window.partitionBy("key", "lone").orderBy("n")
    near = (F.lag("n").over(by_size) * 100 >= F.col("n") * rules.percent) | (
        F.col("n") * 100 >= F.lead("n").over(by_size) * rules.percent
    )
    close = shared.withColumn("lone", lone).withColumn("near", near).where("near or lone >= 0")
    carried = close.drop("lone", "near").join(nodes.select("seat", "bits"), "seat")
    grouped = _by_group(in_blocks(carried, rules))
    maybe = grouped.select("key", "one", "other", "block", "seat", "n", "bits").mapInArrow(
        partial(_light, rules=rules), "a long, b long"
    )

    # Whatever links is connected by pairs that may: these families are compared
    # exactly, each text sent once unless its family has more than a block. Sets
    # are made again, each from a text of its smallest id, found by id and hash: many
    # rows may have one id, or none.
    families = components(maybe, f"{folder}/maybe")
    families = staged(families.union(families.select("label", "label").distinct()), f"{folder}/families")
    sizes = families.groupBy("label").agg(F.count("*").alias("held"))
    wanted = families.join(sizes, "label").join(nodes.select("seat", "node", "least", F.col("text").alias("hash")), "seat")
    wanted = wanted.select(F.col("label").alias("key"), "seat", "node", "least", "hash", "held")
    members = hint_if_small(staged(in_blocks(wanted, rules), f"{folder}/members"))
    same = docs["doc_id"].eqNullSafe(members["least"]) & (F.xxhash64(docs["text"]) == members["hash"])
    again = docs.join(members, same)
    texts = again.select("text", "node", *PLACE).mapInArrow(
        partial(_member_texts, rules=rules),
        "key long, one int, other int, block int, seat long, text string",
    )
    edges = _by_group(texts).mapInArrow(partial(_exact, rules=rules), "a long, b long")
    labels = components(edges, f"{folder}/components")

    # The smallest id of each group: of a node's rows, then of a label's nodes.
    named = nodes.select("node", "seat", "least").join(labels, "seat", "left")
    named = named.withColumn("label", F.coalesce("label", "seat"))
    smallest = named.groupBy("label").agg(F.min("least").alias("component"))
    named = staged(named.join(smallest, "label").select("node", "label", "component"), f"{folder}/named")
    return found.join(named, "node", "left").select(
        "doc_id",
        "own",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
        "node",
        "label",
    )


def one_of_each(docs: DataFrame, folder: str, rules: JoinRules = JoinRules()) -> DataFrame:
    """``docs`` with one row of each group of :func:`jaccard_join`, that of the smallest id.

    Null ids come last, and among rows of one id the smallest hash of the text
    counts; of rows alike in id and text any one stays. Rows without words all
    stay. Columns are as they were. What goes is looked up by id and hash, so the
    documents are shuffled only if that list is long.
    """
    joined = staged(jaccard_join(docs, folder, rules), f"{folder}/joined")
    grouped = joined.where("label is not null").withColumn(
        "place", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "own")
    )
    first = grouped.groupBy("label").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    several = first.where("rows > 1").drop("rows")
    judged = staged(
        grouped.join(several, "label").select("place", (F.col("place") == F.col("first")).alias("stays")),
        f"{folder}/judged",
    )
    key = [F.col("place.doc_id").alias("_key_id"), F.col("place.own").alias("_key_own")]
    gone = judged.where(~F.col("stays")).select(*key).distinct()
    # Rows of which a copy, alike in id and text, stays too.
    copied = judged.where("stays").groupBy("place").count().where("count > 1").select(*key)
    gone, copied = staged(gone, f"{folder}/gone"), staged(copied, f"{folder}/copied")

    def listed(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        keys = hint_if_small(keys)
        same = rows["doc_id"].cast("long").eqNullSafe(keys["_key_id"]) & (
            F.xxhash64(rows["text"].cast("string")) == keys["_key_own"]
        )
        return rows.join(keys, same, how)

    kept = listed(docs, gone, "left_anti")
    if copied.limit(1).count() == 0:
        return kept
    single = listed(kept, copied, "left_semi").dropDuplicates(["doc_id", "text"])
    return listed(kept, copied, "left_anti").unionByName(single)
