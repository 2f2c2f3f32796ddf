"""The n-gram Jaccard join against comparing all pairs."""

from __future__ import annotations

import random
import re
from collections import Counter

import edges
import numpy as np
import pytest
from conftest import SMALL

from tillwarden.llm import jaccard, queries
from tillwarden.llm.common import ready


def shingles(text, size):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, size, percent):
    """(n_shingles, component) of each row, by all pairs of distinct sets."""
    sets = [shingles(t, size) for _, t in rows]
    distinct = list(dict.fromkeys(s for s in sets if s))
    holders = {}
    for n, s in enumerate(distinct):
        for x in s:
            holders.setdefault(x, []).append(n)
    above = list(range(len(distinct)))

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    for n, s in enumerate(distinct):
        shared = Counter(m for x in s for m in holders[x] if m < n)
        for m, overlap in shared.items():
            if 100 * overlap >= percent * (len(s) + len(distinct[m]) - overlap):
                above[root(n)] = root(m)
    least = {}
    number = {s: n for n, s in enumerate(distinct)}
    for (doc_id, _), s in zip(rows, sets, strict=True):
        if s and doc_id is not None:
            r = root(number[s])
            least[r] = min(least.get(r, doc_id), doc_id)
    return [
        (len(s), least.get(root(number[s])) if s else doc_id) for (doc_id, _), s in zip(rows, sets, strict=True)
    ]


def check(rows, got, size, percent):
    want = Counter((r[0], *w) for r, w in zip(rows, brute(rows, size, percent), strict=True))
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == want


@pytest.mark.parametrize("sf_dir", [SMALL, "/root/testdata/sf0.01"])
def test_op7_equals_all_pairs(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(rows, queries.QUERIES["op7_jaccard_join"](spark, sf_dir), 3, 90)


def chain(chance, members, words=60, edits=1):
    """Copies of which each differs a little from the one before."""
    text = [f"w{chance.randrange(3000)}" for _ in range(words)]
    for _ in range(members):
        yield " ".join(text)
        for _ in range(edits):
            text[chance.randrange(words)] = f"w{chance.randrange(3000)}"


@pytest.mark.parametrize(("size", "percent", "block"), [(3, 90, 1024), (3, 90, 16), (5, 80, 16)])
def test_op7_chains_in_blocks(spark, tmp_path, size, percent, block):
    chance = random.Random(size * percent + block)
    texts = [
        *chain(chance, 120),
        *chain(chance, 40, words=400, edits=4),
        *chain(chance, 30, words=15),
        *["a common line of many words here " + t for t in chain(chance, 60, words=30, edits=3)],
    ]
    texts += [t.upper() for t in texts[:10]] + [None, "", " ", "one", "One", "two words"]
    rows = [*enumerate(texts), (None, texts[0]), (3, "two words"), (None, "alone here"), (7, texts[7])]
    docs = ready(spark).createDataFrame(rows, "doc_id long, text string").repartition(5)
    docs = edges.clashing(docs, ["node", "n", "token", "label"])
    rules = jaccard.JoinRules(shingle=size, percent=percent, block=block, sample=50)
    check(rows, jaccard.jaccard_join(docs, str(tmp_path / "join"), rules), size, percent)


def test_op7_edges(spark, tmp_path):
    docs = edges.frame(ready(spark))
    rows = [r[:2] for r in edges.rows()]
    check(rows, jaccard.jaccard_join(docs, str(tmp_path / "join")), 3, 90)
    assert jaccard.jaccard_join(docs.limit(0), str(tmp_path / "none")).count() == 0


def test_op7_bounds_are_never_too_low():
    chance = np.random.default_rng(4)
    rules = jaccard.JoinRules()
    for _ in range(30):
        base = chance.integers(0, 1 << 63, 2000, dtype=np.int64).astype(np.uint64)
        sets = [np.unique(chance.choice(base, chance.integers(1, 900), replace=False)) for _ in range(80)]
        sizes = np.array([len(s) for s in sets])
        low = jaccard.JoinRules(percent=30)
        tree = jaccard.Tree(sizes, [jaccard.bitmap(s) for s in sets], np.argsort(sizes))
        seen = {}
        for i, j, limit in jaccard.leaf_pairs(tree, tree, low):
            seen.update({(min(a, b), max(a, b)): c for a, b, c in zip(i, j, limit, strict=True)})
        for i in range(80):
            for j in range(i):
                overlap = len(np.intersect1d(sets[i], sets[j]))
                if low.enough(overlap, sizes[i], sizes[j]):
                    assert seen[j, i] >= overlap
    assert rules.prefix(10) == 2 and rules.prefix(1) == 1


@pytest.mark.parametrize("percent", [30, 50, 80, 90, 100])
def test_op7_linked_sets_share_more_than_they_spare(percent):
    chance = np.random.default_rng(percent)
    rules = jaccard.JoinRules(percent=percent)
    links = 0
    for _ in range(400):
        n = int(chance.integers(1, 120))
        mine = chance.choice(200, n, replace=False)
        changed = int(chance.integers(0, max(1, n - rules.least(n)) + 1))
        theirs = np.union1d(mine[changed:], chance.choice(200, changed))
        if not len(theirs) or not rules.enough(len(np.intersect1d(mine, theirs)), n, len(theirs)):
            continue
        links += 1
        # The order of the numbers is as good as any order of tokens.
        first, other = (
            np.sort(s)[: rules.prefix(len(s)) + rules.extra(len(s))] for s in (mine, theirs)
        )
        shared = len(np.intersect1d(first, other))
        assert shared > rules.spare(n) and shared > rules.spare(len(theirs))
    assert links > 50
