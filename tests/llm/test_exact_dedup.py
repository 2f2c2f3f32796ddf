"""Exact dedup against plain Python, in one batch and in many."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import defaultdict

import edges
from compare import connect, differences
from conftest import SMALL

from tillwarden.llm import exact_dedup, queries
from tillwarden.llm.common import ready


def digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).digest()


def new_index(spark, folder, buckets=4):
    return exact_dedup.DigestIndex(spark, f"digests_{uuid.uuid4().hex[:8]}", str(folder), buckets).open()


def check(found, rows):
    """``rows``: (id, text), any order. One row of each group is kept, one with its smallest id."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[digest(text)].append(doc_id)
    found = [(r.doc_id, bytes(r.digest), r.keep_id, r.group_size, r.kept) for r in found.collect()]
    assert sorted(map(repr, ((r[0], r[1]) for r in found))) == sorted(repr((k, digest(t))) for k, t in rows)
    kept = defaultdict(int)
    for doc_id, own, keep_id, size, stays in found:
        ids = [i for i in groups[own] if i is not None]
        assert (keep_id, size) == (min(ids, default=None), len(groups[own]))
        assert not stays or doc_id == keep_id
        kept[own] += stays
    assert kept == dict.fromkeys(groups, 1)


def test_op13_equals_sql(spark):
    got = queries.QUERIES["op13_exact_dedup"](spark, SMALL)
    assert differences(got, connect(SMALL), queries.ORACLE["op13_exact_dedup"]) == []
    assert got.where("not kept").count() > 0


SPACED = ["a b", "a  b", "a\t\n\x0b\x0c\rb", "a\x1cb", " a b", "a b ", "\ta b\n", "a b", "a b", "a\x85b", " ", "\n\n", "", None]


def test_op13_edges(spark, tmp_path):
    rows = [*edges.rows(), *[(900 - i, t, None, None, None) for i, t in enumerate(SPACED)]]
    rows += [(None, "no id", None, None, 1), (2000, "no id", "en", "s", 3), (None, "never an id", None, None, None)] * 2
    docs = spark.createDataFrame(rows, edges.SCHEMA).repartition(5)
    docs = edges.clashing(docs, ["digest", "keep_id", "batch", "seat", "source", "kept", "_route"])
    pairs = [(r[0], r[1]) for r in rows]
    for batches in (1, 2, 5):
        index = new_index(ready(spark), tmp_path / str(batches))
        check(exact_dedup.dedup(docs, index, batches), pairs)
        assert index.table().count() == len({digest(t) for _, t in pairs})
    index = new_index(spark, tmp_path / "none")
    assert exact_dedup.dedup(docs.limit(0), index).count() == 0 == index.table().count()


def test_op13_heavy_group(spark, tmp_path):
    rows = [(i, "copy" if i % 3 else f"text {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    check(exact_dedup.dedup(docs, new_index(spark, tmp_path)), rows)


def batch(spark, rows):
    return exact_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string"))


def test_op13_index_outlives_sessions_and_failures(spark, tmp_path):
    first, second = [(5, "a"), (6, "b"), (7, "b")], [(1, "b"), (2, "c"), (3, "c")]
    index = new_index(spark, tmp_path)
    index.add(batch(spark, first), 1)
    spark.sql(f"DROP TABLE {index.name}")
    again = new_index(spark, tmp_path)
    assert again.table().count() == 2
    for _ in range(2):  # the second time as after a failure
        again.add(batch(spark, second), 2)
    assert {(bytes(r.digest), r.keep_id, r.batch) for r in again.table().collect()} == {
        (digest("a"), 5, 1),
        (digest("b"), 6, 1),
        (digest("c"), 2, 2),
    }
    assert again.table().count() == 3
    later = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in again.members([2]).collect()}
    assert later == {1: (6, 1, False), 2: (2, 2, True), 3: (2, 2, False)}
    both = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in again.members([1, 2]).collect()}
    assert both[1] == (6, 3, False) and both[6] == (6, 3, True) and both[7] == (6, 3, False)
    # Half of a batch had come in when it failed.
    again.add(batch(spark, [(8, "d")]), 3)
    again.add(batch(spark, [(8, "d"), (9, "e"), (10, "d")]), 3)
    assert again.table().count() == 5
    assert [r.kept for r in again.members([3]).orderBy("doc_id").collect()] == [True, True, False]


def files(index):
    return len({r.f for r in index.table().selectExpr("input_file_name() f").collect()})


def test_op13_index_is_not_shuffled(spark, tmp_path):
    index = new_index(spark, tmp_path, buckets=8)
    index.add(batch(spark, [(i, f"t{i}") for i in range(100)]), 1)
    assert files(index) == 8
    index.add(batch(spark, [(i, f"t{i}") for i in range(50, 150)]), 2)
    assert files(index) == 16
    before = sorted(map(tuple, index.table().collect()))
    new = batch(spark, [(i, f"t{i}") for i in range(140, 160)]).repartition(8, "digest")
    joined = new.join(index.table().hint("merge"), "digest", "left_anti")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    index.compact()
    assert sorted(map(tuple, index.table().collect())) == before
    assert files(index) == 8
    index.add(batch(spark, [(500, "t1"), (501, "new")]), 3)
    assert index.table().count() == 151 and index.members([3]).where("kept").count() == 1
