"""A Merkle manifest of a dataset: a tree of digests per group, one tree over the groups, a proof per row.

Rows are placed in their group by one range sort. Trees are built in blocks of
1,024 nodes. Proofs come by pointer jumping: each node holds the siblings on the
way to an ancestor, first its parent; joining the nodes with themselves doubles
the distance and appends the ancestor's siblings, until the leaves reach the root.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwarden.llm.common import hint_if_small, staged
from tillwarden.operators.lookup import attach_per_key

# A block of 2 ** LEVELS nodes is built in one row: 64 KB of digests.
LEVELS = 10
# Up to so many rows of some hundred bytes are sent to every executor.
SMALL = 50_000
# An entry of a proof: the side of the sibling (R, L, or - for none), then its digest.
ENTRY = 33
RESULT = "doc_id long, leaf binary, claimed binary, siblings binary, subroot binary, root binary"


def text_digest(text: Column) -> Column:
    """The digest of a text, as bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def row_digest(values: Sequence[Column]) -> Column:
    """The digest of a row: each value as its UTF-8 length, a colon and itself; ``-`` for null."""
    parts = []
    for value in values:
        text = value.cast("string")
        named = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(named, F.lit("-")))
    return text_digest(F.concat(*parts))


def _height(leaves: Column) -> Column:
    """Levels above the leaves: halved, rounding up, until one is left."""
    return F.when(leaves > 1, F.length(F.bin(leaves - 1))).otherwise(0)


def _placed(rows: DataFrame, group: str | None, order: list[str], folder: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``tree`` (the rank of its group), ``place`` (its rank there) and ``height``; and the trees.

    Rows are dealt to ranges and sorted once; ranks are places within a range plus
    the sizes of earlier ranges, so no group is brought to one task. Of the trees:
    the group, ``tree``, ``leaves`` and ``height``.
    """
    keys = [*([group] if group else []), *order]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    dealt = dealt.withColumn("seat", F.monotonically_increasing_id())
    dealt = staged(dealt, f"{folder}/sorted").withColumn("part", F.shiftright("seat", 33))
    grouped = F.col(group) if group else F.lit(None).cast("string")
    sections = dealt.groupBy(grouped.alias("group"), "part").agg(F.count("*").alias("held"), F.min("seat").alias("first"))
    earlier = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sections = sections.withColumn("ahead", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
    sections = staged(sections, f"{folder}/sections")
    trees = sections.groupBy("group").agg(F.sum("held").alias("leaves"))
    if group:
        trees, _ = _placed(trees, None, ["group"], f"{folder}/trees")
        trees = trees.select("group", F.col("place").alias("tree"), "leaves")
    else:
        trees = trees.withColumn("tree", F.lit(0).cast("long"))
    trees = staged(trees.withColumn("height", _height(F.col("leaves"))), f"{folder}/heights")
    known = sections.join(
        hint_if_small(trees.withColumnRenamed("group", "of"), SMALL), F.col("group").eqNullSafe(F.col("of"))
    ).select(F.col("group").alias("in_group"), F.col("part").alias("in_part"), "first", "ahead", "tree", "height")
    known = hint_if_small(staged(known, f"{folder}/known"), SMALL)
    same = (F.col("part") == F.col("in_part")) & F.col("in_group").eqNullSafe(grouped)
    place = F.col("seat") - F.col("first") + F.col("ahead")
    found = dealt.join(known, same)
    return found.select(*rows.columns, "tree", place.alias("place"), "height"), trees


def _parents(digests: Column) -> Column:
    """The digests one level up: of every two consecutive ones, or of a last one alone."""
    pair = lambda i: F.concat(hexed(F.get(digests, 2 * i)), F.coalesce(hexed(F.get(digests, 2 * i + 1)), F.lit("")))
    return F.transform(
        F.sequence(F.lit(0), F.shiftright(F.size(digests) - 1, 1)), lambda i: text_digest(pair(i))
    )


def _nodes(leaves: DataFrame, tallest: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """All nodes below the roots with the entry of their sibling; and the ``root`` of each tree.

    ``leaves``: ``tree``, ``height``, ``place``, ``digest``, ``doc_id``, ``claimed``.
    The last two are carried by the nodes of level 0.
    """
    current = leaves.select("tree", "height", F.col("place").alias("pos"), "digest", "doc_id", "claimed")
    roots, nodes = [current.where("height = 0").select("tree", F.col("digest").alias("root"))], []
    for base in range(0, tallest, LEVELS):
        own = F.struct("pos", "digest", "doc_id", "claimed")
        blocks = (
            current.where(F.col("height") > base)
            .groupBy("tree", "height", F.shiftright("pos", LEVELS).alias("block"))
            .agg(F.sort_array(F.collect_list(own)).alias("own"))
        )
        steps = F.least(F.lit(LEVELS), F.col("height") - base)
        levels = F.aggregate(
            F.sequence(F.lit(1), steps),
            F.array(F.transform("own", lambda x: x["digest"])),
            lambda made, _: F.concat(made, F.array(_parents(F.element_at(made, -1)))),
        )
        blocks = staged(blocks.withColumn("levels", levels), f"{folder}/blocks-{base}")
        top = F.get(F.element_at("levels", -1), F.lit(0))
        nothing = [F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("claimed")]
        current = blocks.select("tree", "height", F.col("block").alias("pos"), top.alias("digest"), *nothing)
        roots.append(current.where(F.col("height") <= base + LEVELS).select("tree", F.col("digest").alias("root")))
        nodes.append(_block_nodes(blocks, base))
    return reduce(DataFrame.unionByName, nodes) if nodes else None, reduce(DataFrame.unionByName, roots)


def _block_nodes(blocks: DataFrame, base: int) -> DataFrame:
    # The last level of a block is the first of the next block up, or a root.
    below = F.slice("levels", F.lit(1), F.size("levels") - 1)
    rows = blocks.select("tree", "height", "block", "own", F.posexplode(below).alias("up", "digests"))
    rows = rows.select(
        "tree",
        "height",
        "block",
        "up",
        "digests",
        F.when(F.col("up") == 0, F.col("own")).alias("own"),
        F.posexplode("digests").alias("i", "digest"),
    )
    right, left = F.get("digests", F.col("i") + 1), F.get("digests", F.col("i") - 1)
    side = lambda mark, digest: F.concat(F.lit(mark).cast("binary"), digest)
    entry = (
        F.when(F.col("i") % 2 == 1, side("L", left))
        .when(right.isNotNull(), side("R", right))
        .otherwise(F.lit(bytearray(b"-" + bytes(ENTRY - 1))))
    )
    leaf = F.get("own", F.col("i"))
    known = {n: leaf[n] if base == 0 else F.lit(None).cast(k) for n, k in (("doc_id", "long"), ("claimed", "binary"))}
    return rows.select(
        "tree",
        "height",
        (F.col("up") + base).alias("level"),
        (F.expr(f"shiftleft(block, {LEVELS} - up)") + F.col("i")).alias("pos"),
        F.when(F.col("up") + base == 0, F.col("digest")).alias("leaf"),
        *[c.alias(n) for n, c in known.items()],
        entry.alias("siblings"),
        (F.col("up") + (base + 1)).alias("reach"),
    )


def _proofs(nodes: DataFrame, tallest: int, folder: str) -> DataFrame:
    """The leaves with the entries of all siblings up to the root of their tree.

    After a round that starts with segments of ``step`` levels, only nodes on
    levels that are multiples of ``2 * step`` can still be an ancestor jumped to, so
    only these and the leaves are kept. An ancestor is joined to at most ``2 **
    step`` nodes; once ancestors are few, they are sent to every task.
    """
    done, step = [], 1
    arrived = F.col("reach") == F.col("height")
    while step < tallest:
        done.append(nodes.where((F.col("level") == 0) & arrived))
        ancestors = nodes.where((F.col("level") > 0) & (F.col("level") % step == 0)).select(
            F.col("tree").alias("of"),
            F.col("level").alias("at"),
            F.col("pos").alias("node"),
            F.col("siblings").alias("more"),
            F.col("reach").alias("further"),
        )
        kept = nodes.where(F.col("level") % (2 * step) == 0)
        going = kept.where(~arrived).withColumn("node", F.expr("shiftright(pos, reach - level)"))
        ancestors = hint_if_small(ancestors, SMALL)
        met = (F.col("tree") == F.col("of")) & (F.col("reach") == F.col("at")) & (going["node"] == ancestors["node"])
        jumped = going.join(ancestors, met).select(
            *[c for c in nodes.columns if c not in ("siblings", "reach")],
            F.concat("siblings", "more").alias("siblings"),
            F.col("further").alias("reach"),
        )
        step *= 2
        nodes = jumped.unionByName(kept.where((F.col("level") > 0) & arrived))
        if step < tallest:
            nodes = staged(nodes, f"{folder}/reach-{step}")
    done.append(nodes.where((F.col("level") == 0) & arrived))
    found = reduce(DataFrame.unionByName, done)
    return found.select("tree", "pos", "doc_id", "leaf", "claimed", "siblings")


def _forest(leaves: DataFrame, tallest: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """A proof per leaf, and the root per tree."""
    nodes, roots = _nodes(leaves, tallest, folder)
    lone = leaves.where("height = 0").select(
        "tree",
        F.col("place").alias("pos"),
        "doc_id",
        F.col("digest").alias("leaf"),
        "claimed",
        F.lit(bytearray()).alias("siblings"),
    )
    if nodes is None:
        return lone, roots
    return _proofs(nodes, tallest, folder).unionByName(lone), roots


def manifest(rows: DataFrame, folder: str) -> DataFrame:
    """Proofs of all rows: ``doc_id``, ``leaf``, ``claimed``, ``siblings``, ``subroot`` and ``root``.

    ``rows`` has ``group`` (string), ``doc_id`` (long), ``leaf`` (a digest) and ``claimed``
    (another digest to verify later, or null), which is only carried. Per group,
    leaves ascend by ``doc_id`` (null first), then by digest, so rows alike in all columns
    are interchangeable; groups ascend bytewise, the null group first. ``siblings``
    are entries of 33 bytes from the leaf to the root (:func:`folded`); a row alone has
    none and is the root. No rows give no rows. Wide columns need not come along: only
    digests are shuffled. Steps are written to ``folder``, so lost executors cost their own tasks.
    """
    spark = rows.sparkSession
    keyed = rows.select(
        F.col("group").cast("string").alias("lineage"), "doc_id", F.col("leaf").alias("digest"), "claimed"
    ).withColumn("tie", F.monotonically_increasing_id())
    leaves, trees = _placed(keyed, "lineage", ["doc_id", "digest", "tie"], f"{folder}/leaves")
    groups, tallest = trees.agg(F.count("*"), F.max("height")).first()
    if not groups:
        return spark.createDataFrame([], RESULT)
    proofs, subroots = _forest(leaves, tallest, f"{folder}/groups")
    subroots = staged(subroots, f"{folder}/subroots")
    # The groups' roots are the leaves of the last tree, in the order of the trees' numbers.
    height = (groups - 1).bit_length()
    tops = subroots.select(
        F.lit(0).cast("long").alias("tree"),
        F.col("tree").alias("place"),
        F.col("root").alias("digest"),
        F.lit(None).cast("long").alias("doc_id"),
        F.lit(None).cast("binary").alias("claimed"),
        F.lit(height).alias("height"),
    )
    above, root = _forest(tops, height, f"{folder}/top")
    above = staged(
        above.select(
            F.col("pos").alias("tree"), F.col("leaf").alias("subroot"), F.col("siblings").alias("above")
        ).join(trees.select("tree", "leaves"), "tree"),
        f"{folder}/above",
    )
    if above.limit(SMALL + 1).count() <= SMALL:
        found = proofs.join(F.broadcast(above), "tree")
    else:
        found = attach_per_key(proofs, above, "tree", weight="leaves", spread="pos")
    whole = F.lit(bytearray(root.first()["root"]))
    return found.select(
        "doc_id", "leaf", "claimed", F.concat("siblings", "above").alias("siblings"), "subroot", whole.alias("root")
    )


def _entries(siblings: Column) -> Column:
    """The starts of the entries, from 0."""
    n = F.floor(F.octet_length(siblings) / ENTRY).cast("int")
    starts = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: i * ENTRY)
    return F.when(n > 0, starts).otherwise(F.array().cast("array<int>"))


def _entry(siblings: Column, start: Column) -> tuple[Column, Column]:
    """Side and digest, as text, of the entry at a start."""
    side = siblings.substr(start + 1, F.lit(1)).cast("string")
    return side, hexed(siblings.substr(start + 2, F.lit(ENTRY - 1)))


def folded(leaf: Column, siblings: Column) -> Column:
    """The root, as bytes, that a leaf has under these siblings: equal to the true one only for the true leaf."""

    def up(at: Column, start: Column) -> Column:
        side, digest = _entry(siblings, start)
        joined = F.when(side == "L", F.concat(digest, at)).when(side == "R", F.concat(at, digest)).otherwise(at)
        return F.sha2(joined.cast("binary"), 256)

    return F.unhex(F.aggregate(_entries(siblings), hexed(leaf), up))


def proof_text(siblings: Column) -> Column:
    """The digests of all siblings as text, lowest level first."""

    def text(start: Column) -> Column:
        side, digest = _entry(siblings, start)
        return F.when(side == "-", F.lit("")).otherwise(digest)

    return F.array_join(F.transform(_entries(siblings), text), "")


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def document_leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """What :func:`manifest` takes, of documents; ``claimed`` is the digest with one more in ``n_chars``.

    It is made where ``tampered`` holds and null elsewhere. A null in any column is
    hashed as a null; texts are hashed whole.
    """
    kinds = {"doc_id": "long", "n_chars": "long"}
    named = {c: F.col(c).cast(kinds.get(c, "string")) for c in COLUMNS}
    changed = {**named, "n_chars": named["n_chars"] + 1}
    claimed = F.lit(None).cast("binary")
    if tampered is not None:
        claimed = F.when(tampered, row_digest(list(changed.values())))
    return docs.select(
        named["lang"].alias("group"),
        named["doc_id"].alias("doc_id"),
        row_digest(list(named.values())).alias("leaf"),
        claimed.alias("claimed"),
    )


ORACLE = r"""
    WITH RECURSIVE
    fields AS (
        SELECT
            doc_id,
            lang,
            n_chars,
            coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-')
                || coalesce(strlen(source) || ':' || source, '-')
                || coalesce(strlen(lang) || ':' || lang, '-') AS head,
            coalesce(strlen(text) || ':' || text, '-') AS tail,
            coalesce(list_reduce(
                list_prepend(
                    4294967295::BIGINT,
                    list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ord(s)::BIGINT)
                ),
                lambda c, b: list_reduce(
                    list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                    lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
                )
            ), 0) AS remainder
        FROM documents
    ),
    hashed AS (
        SELECT
            doc_id,
            lang,
            sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
            CASE
                WHEN doc_id IS NOT NULL AND xor(remainder, 4294967295) % 7 = 0
                    THEN sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail)
            END AS claimed
        FROM fields
    ),
    leaves AS (
        SELECT
            *,
            row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
            count(*) OVER (PARTITION BY lang) AS width
        FROM hashed
    ),
    tree AS (
        SELECT lang, 0 AS level, pos, leaf AS digest, width FROM leaves
        UNION ALL
        SELECT lang, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(width) + 1) // 2
        FROM tree
        WHERE width > 1
        GROUP BY lang, level, pos // 2
    ),
    subroots AS (
        SELECT
            lang,
            digest,
            row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos,
            count(*) OVER () AS width
        FROM tree
        WHERE width = 1
    ),
    top AS (
        SELECT 0 AS level, pos, digest, width FROM subroots
        UNION ALL
        SELECT level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(width) + 1) // 2
        FROM top
        WHERE width > 1
        GROUP BY level, pos // 2
    ),
    sides AS (
        SELECT
            t.lang,
            t.level,
            t.pos,
            CASE WHEN s.pos IS NULL THEN '-' WHEN s.pos < t.pos THEN 'L' || s.digest ELSE 'R' || s.digest END AS entry
        FROM tree t
        LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM t.lang AND s.level = t.level AND s.pos = xor(t.pos, 1)
        WHERE t.width > 1
    ),
    ways AS (
        SELECT l.lang, l.pos, list(s.entry ORDER BY s.level) AS entries
        FROM leaves l
        JOIN sides s ON s.lang IS NOT DISTINCT FROM l.lang AND s.pos = l.pos >> s.level
        GROUP BY l.lang, l.pos
    ),
    top_sides AS (
        SELECT
            t.level,
            t.pos,
            CASE WHEN s.pos IS NULL THEN '-' WHEN s.pos < t.pos THEN 'L' || s.digest ELSE 'R' || s.digest END AS entry
        FROM top t
        LEFT JOIN top s ON s.level = t.level AND s.pos = xor(t.pos, 1)
        WHERE t.width > 1
    ),
    top_ways AS (
        SELECT r.lang, r.digest AS subroot, list(s.entry ORDER BY s.level) FILTER (s.entry IS NOT NULL) AS entries
        FROM subroots r
        LEFT JOIN top_sides s ON s.pos = r.pos >> s.level
        GROUP BY r.lang, r.digest
    ),
    proven AS (
        SELECT
            l.doc_id,
            l.leaf,
            t.subroot,
            (SELECT digest FROM top WHERE width = 1) AS root,
            coalesce(l.claimed, l.leaf) AS first,
            list_concat(coalesce(w.entries, []::VARCHAR[]), coalesce(t.entries, []::VARCHAR[])) AS entries
        FROM leaves l
        LEFT JOIN ways w ON w.lang IS NOT DISTINCT FROM l.lang AND w.pos = l.pos
        JOIN top_ways t ON t.lang IS NOT DISTINCT FROM l.lang
    ),
    checked AS (
        SELECT
            *,
            list_reduce(
                list_prepend(first, entries),
                lambda a, e: CASE e[1]
                    WHEN 'L' THEN sha256(e[2:] || a)
                    WHEN 'R' THEN sha256(a || e[2:])
                    ELSE sha256(a)
                END
            ) AS folded_root
        FROM proven
    )
    SELECT
        doc_id,
        leaf,
        subroot,
        root,
        sha256(list_aggregate(list_prepend('', list_transform(entries, lambda e: e[2:])), 'string_agg', '')) AS proof_sha256,
        folded_root,
        folded_root = root AS verified
    FROM checked
"""
