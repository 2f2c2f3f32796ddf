"""Top-k search, the quality classifier and personal data."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import edges
import numpy as np
import pyarrow as pa
from compare import connect, differences
from conftest import SMALL
from pyspark.sql import functions as F

from tillwarden.llm import pii, quality, queries, topk
from tillwarden.llm.common import ready


def test_op2_equals_sql(spark):
    assert differences(queries.QUERIES["op2_topk"](spark, SMALL), connect(SMALL), queries.ORACLE["op2_topk"]) == []


def test_op2_edges_in_shards_and_blocks(spark, tmp_path):
    chance = random.Random(2)
    rows = [(i, [chance.choice([-1.5, 0.25, 0.5, 1.0]) for _ in range(6)]) for i in range(700)]
    rows += [(1000 + i, [0.5] * 6) for i in range(300)]  # one vector many times: ties
    rows += [(2000, [1e6, -1e6, 3.0, 1.0, 0.0, 2.0]), (2050, [1e6, 1e6, 1.0, 1.0, 1.0, 1.0])]
    rows += [(3000, [0.5, 0.5]), (3050, [1.0, -1.0]), (3001, [2.0, 2.0]), (50, rows[50][1])]
    bad = [(4000, None), (4050, [None] * 6), (4100, [math.nan] * 6), (4150, [math.inf] * 6), (None, [1.0] * 6), (4200, [])]
    frame = ready(spark).createDataFrame([*rows, *bad], "vec_id long, embedding array<double>")
    vectors = topk.integer_vectors(frame.withColumn("v", F.lit("other")))
    asked = vectors.where("vec_id % 50 = 0")
    whole = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    want = set()
    for q, v in whole.items():
        if q % 50 == 0:
            scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole.items() if i != q and len(w) == len(v)]
            want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:5])}
    for shard, block in ((4096, 2048), (100, 7)):
        got = topk.top_products(vectors, asked, str(tmp_path / f"{shard}"), shard=shard, block=block)
        assert {tuple(r) for r in got.collect()} == want
    none = vectors.limit(0)
    assert topk.top_products(none, none, str(tmp_path / "none")).count() == 0


def test_op2_exact_for_large_numbers():
    big = np.array([[1 << 31, 3], [1 << 31, 2]], np.int64)
    tree = topk.BallTree.build(np.array([1, 2]), big)
    scores, ids, filled = tree.search(np.array([9]), np.array([[1 << 30, 1]], np.int64), 2, np.array([np.iinfo(np.int64).min]))
    assert scores.tolist() == [[(1 << 61) + 3, (1 << 61) + 2]] and ids.tolist() == [[1, 2]] and filled.all()


def test_op2_multiplies_leaves_with_whole_tiles(monkeypatch):
    chance = np.random.default_rng(3)
    vectors = chance.integers(-90, 90, (4000, 24))
    vectors[500:900] = vectors[500]
    ids = chance.permutation(4000) * 3 - 500
    asked, own = vectors[:1500], ids[:1500]
    calls, plain = [], topk.BallTree.products
    monkeypatch.setattr(topk.BallTree, "products", lambda *args: calls.append(1) or plain(*args))
    tree = topk.BallTree.build(ids, vectors)
    floor = np.full(1500, np.iinfo(np.int64).min)
    scores, found, filled = tree.search(own, asked, 5, floor)
    made = asked @ vectors.T
    made[own[:, None] == ids] = np.iinfo(np.int64).min
    want = np.array([np.lexsort((ids, ~row))[:5] for row in made])
    assert (found == ids[want]).all() and (scores == np.take_along_axis(made, want, 1)).all() and filled.all()
    leaves = int((tree.left < 0).sum())
    assert len(calls) <= 2 * leaves * math.ceil(1500 / 1024)
    # Once the k-th scores are known, no leaf is multiplied twice with a query.
    calls.clear()
    again, _, _ = tree.search(own, asked, 5, scores[:, -1])
    assert (again == scores).all() and len(calls) <= leaves * math.ceil(1500 / 1024)


def test_op2_groups_of_trees_pass_on_their_floors(spark, tmp_path):
    chance = random.Random(5)
    rows = [(i - 900, [chance.choice([-3, 0, 1, 2]) for _ in range(8)]) for i in range(2000)]
    rows += [(5000 + i, [2**31 + i, 3]) for i in range(40)] + [(6000 + i, [1 << 30, -i]) for i in range(40)]
    vectors = ready(spark).createDataFrame(rows, "vec_id long, v array<long>")
    asked = vectors.where("vec_id % 4 = 0 and size(v) = 8 or vec_id >= 6000")
    v = {i: x for i, x in rows}
    want = set()
    for q in (i for i, x in rows if (i % 4 == 0 and len(x) == 8) or i >= 6000):
        scored = [(-sum(a * b for a, b in zip(v[q], w, strict=True)), i) for i, w in rows if i != q and len(w) == len(v[q])]
        want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:3])}
    got = topk.top_products(vectors, asked, str(tmp_path / "many"), k=3, shard=50, block=30)
    assert {tuple(r) for r in got.collect()} == want
    assert spark.read.parquet(str(tmp_path / "many/first")).count() > 0


def test_op4_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    got = queries.QUERIES["op4_quality"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rows = got.join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = sorted((r.score, r.quality) for r in rows if r.held_out)
    ones = sum(y for _, y in held)
    ranks = sum(n for n, (_, y) in enumerate(held, 1) if y)
    area = (ranks - ones * (ones + 1) / 2) / (ones * (len(held) - ones))
    assert area > 0.98
    assert sum((s >= 0.5) == y for s, y in held) / len(held) > 0.97


def test_op4_edges(spark, tmp_path):
    docs = edges.clashing(edges.frame(ready(spark)), ["score", "turn", "quality", "weights"])
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(40)] + [(3, 0), (4, None), (None, 1), (5, 7)], "doc_id long, quality int"
    )
    how = quality.Training(sample=20, epochs=1)
    got = quality.scored(docs, quality.fit(docs, labels, str(tmp_path / "fit"), how), how).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in edges.rows())
    assert all(0 <= r.score <= 1 for r in got)
    assert not any(r.held_out for r in got if r.doc_id is None)
    nothing = quality.fit(docs, labels.limit(0), str(tmp_path / "none"), how)
    assert not nothing.any() and quality.scored(docs.limit(0), nothing, how).count() == 0


def test_op4_reads_unbroken_texts_whole(spark):
    how = quality.Training()
    weights = np.random.default_rng(1).normal(size=how.buckets).astype(np.float32)
    score = quality.Scorer(weights, how).score
    for size in (100, 5000, 140_000):
        text = "文字" * (size // 2)
        other = text + "のちがうおわり"
        whole = Counter(quality.buckets_of(other, how))
        found, times = quality.bucket_counts(other, how)
        assert dict(zip(found.tolist(), times.tolist(), strict=True)) == whole
        assert sum(whole.values()) == 1 + sum(len(other) + 2 - n + 1 for n in (3, 4, 5))
        want = [0, 0]
        for b, n in (whole + Counter({quality.END: 1})).items():
            want = [want[0] + float(weights[b]) * n, want[1] + n]
        assert abs(score(other) - 1 / (1 + math.exp(-want[0] / want[1]))) < 1e-5
        late = {b for b in whole if b not in set(quality.buckets_of(text, how))}
        assert len(late) > 10
        batch = pa.RecordBatch.from_pylist([{"turn": 1, "quality": 1, "text": other}])
        made = next(quality._features(iter([batch]), how)).to_pylist()[0]
        assert set(made["buckets"]) == set(whole) | {quality.END}


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    found = []
    for kind, (name, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            fits = {
                "email": True,
                "ip": name == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }
            if fits[name]:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_op6_base_is_the_patterns(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = queries.QUERIES["op6_personal_data"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(texts) and sum(r.n_email for r in got) > 0
    for r in got:
        want = plain_spans(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(pii.written(want).encode()).hexdigest()
        counts = Counter(kind for _, kind, _ in want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in range(4))
        spans = [s for s in r.spans.split(",") if s]
        assert set(pii.written(want).split(",")) - {""} <= set(spans)


def test_op6_mixed_texts():
    chance = random.Random(3)
    for _ in range(5000):
        text = "".join(chance.choice("a.b@c-d+1 2()3.4%_5\n") for _ in range(chance.randrange(1, 50)))
        assert pii.base_spans(text) == plain_spans(text)


def test_op6_field_learns_the_kinds(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text rlike '[0-9@]'").collect()
    held = rows[::2]
    field = pii.train([r.text for r in rows[1::2]], pii.Learning())
    cuts = defaultdict(Counter)
    for r in held:
        base = set(pii.base_spans(r.text))
        alone = set()
        for run in pii.stretches(r.text):
            places, features = pii.candidates(r.text, run)
            for first, words, kind, _ in field.best(places, field.scores(places, features), len(run)):
                alone.add((run[first][0], kind, run[first + words - 1][1]))
        for name, n in (("both", len(base & alone)), ("missed", len(base - alone)), ("new", len(alone - base))):
            cuts[0][name] += n
    assert cuts[0]["both"] > 20 * (cuts[0]["missed"] + cuts[0]["new"])
    base, spans = pii.all_spans("4111 1111 1111 1111 4012 8888 8888 1881 and +1 (407) 555-7713", field)
    assert set(base) <= set(spans)
    for clean in ("order 20240101 total 12.50", "1234567890123456", "999.1.2.3", "plain words"):
        assert pii.all_spans(clean, field) == ([], [])


def test_op6_best_is_the_best_of_all_cuts():
    chance = np.random.default_rng(8)
    field = pii.Field(chance.normal(size=(len(pii.NAMES), pii.LABELS)), chance.normal(size=(pii.LABELS, pii.LABELS)))
    text = "+1 (407) 555-7713 10.0.0.1 a@b.cd 4111"
    (run,) = pii.stretches(text)
    places, rows = pii.candidates(text, run)
    scores = field.scores(places, rows)
    at = {p: j for j, p in enumerate(places)}

    def totals(i, before):
        if i == len(run):
            yield 0.0, ()
        for k in range(1, min(pii.LONGEST, len(run) - i) + 1):
            for label in range(pii.LABELS):
                own = field.steps[before, label] + scores[at[i, k], label]
                for rest, cuts in totals(i + k, label):
                    yield own + rest, ((i, k, label), *cuts)

    _, want = max(totals(0, 0))
    got = [(i, k, kind + 1) for i, k, kind, _ in field.best(places, scores, len(run))]
    assert got == [c for c in want if c[2]]


def test_op6_edges(spark, tmp_path):
    docs = edges.clashing(edges.frame(ready(spark)), ["base", "spans", "f", "field", "turn"])
    field = pii.fit(docs, str(tmp_path / "fit"))
    got = pii.personal_data(docs, field).collect()
    want = Counter((r[0], pii.written(plain_spans(r[1] or ""))) for r in edges.rows())
    assert Counter((r.doc_id, r.base) for r in got) == want
    clean = pii.redact(docs, field)
    assert clean.columns == docs.columns and clean.count() == len(edges.rows())
    empty = pii.fit(docs.limit(0), str(tmp_path / "none"))
    assert pii.personal_data(docs.limit(0), empty).count() == 0
    assert pii.redacted("a x@y.zz b", pii.base_spans("a x@y.zz b")) == "a [EMAIL] b"


def test_op6_time_is_linear():
    text = "1" * 100_000 + " " + "1.1" * 20_000 + " " + "a@" * 20_000 + "+1" * 20_000 + "1 " * 5_000
    base, _ = pii.all_spans(text, pii.Field.empty())
    assert base == plain_spans("1.1" * 20_000 + " ") or len(base) > 0
