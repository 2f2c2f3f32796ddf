"""The Merkle manifest against plain Python and SQL."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import edges
import pytest
from compare import connect, differences
from conftest import SMALL
from pyspark.sql import functions as F

from tillwarden.llm import merkle, queries
from tillwarden.llm.common import ready


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(digests):
    """The root of a list of digests, and for each the entries of its siblings."""
    ways, places = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for way, p in zip(ways, places, strict=True):
            other = p ^ 1
            way.append(("-", "") if other >= len(digests) else ("L" if other < p else "R", digests[other]))
        digests = [sha("".join(digests[i : i + 2])) for i in range(0, len(digests), 2)]
        places = [p // 2 for p in places]
    return digests[0], ways


def brute(rows, lie):
    """(doc_id, leaf, subroot, root, proof, folded) per row of documents; ``lie(doc_id)`` says which claim more."""
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        leaf = sha("".join(map(field, (doc_id, source, lang, n_chars, text))))
        more = n_chars if n_chars is None or not lie(doc_id) else n_chars + 1
        claim = sha("".join(map(field, (doc_id, source, lang, more, text))))
        groups[lang].append(((doc_id is not None, doc_id or 0, leaf), doc_id, leaf, claim))
    order = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for lang in order:
        groups[lang].sort(key=lambda g: g[0])
        trees[lang] = climb([g[2] for g in groups[lang]])
    root, above = climb([trees[lang][0] for lang in order])
    for lang, over in zip(order, above, strict=True):
        subroot, ways = trees[lang]
        for (_, doc_id, leaf, claim), way in zip(groups[lang], ways, strict=True):
            at = claim
            for side, digest in way + over:
                at = sha(digest + at if side == "L" else at + digest)
            yield doc_id, leaf, subroot, root, sha("".join(d for _, d in way + over)), at, at == root


def claims_more(doc_id):
    import zlib

    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0


def results(spark, docs, folder):
    lie = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = merkle.manifest(merkle.document_leaves(docs, lie), str(folder))
    at = merkle.hexed(merkle.folded(F.coalesce("claimed", "leaf"), F.col("siblings")))
    rows = rows.select(
        "doc_id",
        *[merkle.hexed(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        F.sha2(merkle.proof_text(F.col("siblings")), 256).alias("proof"),
        at.alias("at"),
    )
    return Counter(map(tuple, rows.withColumn("verified", F.col("at") == F.col("root")).collect()))


def test_op12_equals_sql(spark):
    got = queries.QUERIES["op12_merkle_manifest"](spark, SMALL)
    assert differences(got, connect(SMALL), queries.ORACLE["op12_merkle_manifest"]) == []
    assert 0 < got.where("not verified").count() < got.count() / 3


def shaped(kind):
    if kind == "edges":
        return edges.rows()
    if kind == "one row":
        return [(1, "t", None, "s", 3)]
    if kind == "a language each":
        return [(i % 3 or None, f"t{i}", f"l{i}é" if i else None, None, i) for i in range(21)]
    if kind == "alike":
        return [(7, "same", "en", "s", 4)] * 65 + [(7, "same", None, "s", 4)]
    return [(i, f"t{i}", "en" if i % 3 else ["de", "fr", None, "Ω"][i % 4], "s", i) for i in range(2700)]


@pytest.mark.parametrize("kind", ["edges", "one row", "a language each", "alike", "deep"])
def test_op12_equals_plain_python(spark, tmp_path, kind):
    rows = shaped(kind)
    docs = spark.createDataFrame(rows, edges.SCHEMA).repartition(3)
    docs = edges.clashing(ready(spark) and docs, ["tree", "leaf", "group", "pos", "seat", "height", "digest", "root"])
    assert results(spark, docs, tmp_path) == Counter(brute(rows, claims_more))


def test_op12_no_rows(spark, tmp_path):
    docs = spark.createDataFrame([], edges.SCHEMA)
    rows = merkle.manifest(merkle.document_leaves(docs), str(tmp_path))
    assert rows.count() == 0 and rows.columns == ["doc_id", "leaf", "claimed", "siblings", "subroot", "root"]


def test_op12_joins_beyond_the_broadcast(spark, tmp_path, monkeypatch):
    """Every table too large to be sent to all tasks, blocks of two levels: the same rows."""
    monkeypatch.setattr(merkle, "SMALL", 0)
    monkeypatch.setattr(merkle, "LEVELS", 2)
    rows = shaped("deep")[:400] + edges.rows()
    docs = spark.createDataFrame(rows, edges.SCHEMA).repartition(3)
    assert results(spark, docs, tmp_path) == Counter(brute(rows, claims_more))


def test_op12_a_changed_row_fails(spark, tmp_path):
    rows = merkle.manifest(merkle.document_leaves(spark.createDataFrame(shaped("deep")[:50], edges.SCHEMA)), str(tmp_path))
    other = F.sha2(F.lit("another"), 256)
    checks = rows.select(
        (merkle.folded(F.col("leaf"), F.col("siblings")) == F.col("root")).alias("own"),
        (merkle.folded(F.unhex(other), F.col("siblings")) == F.col("root")).alias("changed"),
    ).collect()
    assert len(checks) == 50 and all(r.own and not r.changed for r in checks)
