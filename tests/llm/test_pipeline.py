"""Every stage of the pipeline against plain Python, on its own input."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import edges
import public_tokenizers
import test_jaccard
import test_quality_rules
import test_tokens
from conftest import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tillwarden.llm import pii, quality_rules
from tillwarden.llm.common import ready


def histograms(text):
    words = test_quality_rules.re.findall(r"[^\x20\x09-\x0D]+", text)
    n, chars, symbols, *_ = test_quality_rules.counts(text)
    digits, marks = (len(test_quality_rules.re.findall(p, text)) for p in ("[0-9]", "[.,;:!?'\"()-]"))
    common = Counter(w.lower() for w in words)
    own = [common[w] for w in quality_rules.COMMON_WORDS]
    return [chars - symbols - digits - marks, digits, marks, symbols, len(text) - chars], [*own, n - sum(own)]


def distance(a, b):
    if not sum(a) or not sum(b):
        return 0.0
    found = 0.0
    for p, r in zip([x / sum(a) for x in a], [x / sum(b) for x in b], strict=True):
        found += sum(x / 2 * math.log2(2 * x / (p + r)) for x in (p, r) if x)
    return math.sqrt(max(found, 0.0))


def plain_quality(rows):
    """The rows that the rules keep: each against the others of its language, else the nearest reference."""
    rules = quality_rules.QualityRules()
    made = [histograms(r["text"] or "") for r in rows]
    sums, documents = defaultdict(lambda: [[0] * len(h) for h in made[0]]), Counter(r["lang"] for r in rows)
    for r, own in zip(rows, made, strict=True):
        sums[r["lang"]] = [[x + y for x, y in zip(*pair, strict=True)] for pair in zip(sums[r["lang"]], own, strict=True)]
    for r, own in zip(rows, made, strict=True):
        n, _, _, _, repeats = test_quality_rules.counts(r["text"] or "")
        if n < rules.min_words or 100 * repeats > rules.repeat_percent * n:
            continue
        others = {}
        for lang, reference in sums.items():
            mine = lang == r["lang"]
            if lang is None or documents[lang] - mine < rules.reference_documents:
                continue
            others[lang] = [[x - y * mine for x, y in zip(*pair, strict=True)] for pair in zip(reference, own, strict=True)]
        if r["lang"] in others and sum(others[r["lang"]][1]) >= rules.reference_words:
            others = {r["lang"]: others[r["lang"]]}
        near = [[distance(h, other[k]) for other in others.values()] for k, h in enumerate(own)]
        char, word = (min(d, default=0.0) for d in near)
        if n >= rules.guard_words and char > rules.char_distance:
            continue
        if n >= rules.word_guard and word > rules.word_distance:
            continue
        yield r


def as_dicts(rows):
    return [r.asDict() for r in rows.collect()]


def counted(rows):
    return Counter(tuple(sorted(r.items(), key=str)) for r in rows)


def check_stages(spark, docs, tmp_path):
    results, rows = {}, docs
    for name, apply in corpus_pipeline.STAGES:
        made = apply(spark, rows, SMALL)
        made.write.parquet(str(tmp_path / name))
        before, rows = as_dicts(rows), spark.read.parquet(str(tmp_path / name))
        results[name] = (before, as_dicts(rows))
        if name != "packing":
            assert rows.columns == docs.columns
    before, after = results["quality_rules"]
    assert counted(after) == counted(plain_quality(before))

    before, after = results["line_dedup"]
    null_first = sorted(before, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    kept = test_quality_rules.removed([(r["doc_id"], r["text"]) for r in null_first])
    want = []
    for r in before:
        _, gone, text = kept[r["doc_id"], r["text"]]
        if not gone or test_quality_rules.re.search(r"[^ \t\n\v\f\r]", text):
            want.append({**r, "text": text, "n_chars": len(text or "") if text != r["text"] else r["n_chars"]})
    assert counted(after) == counted(want)

    before, after = results["near_duplicates"]
    pairs = [(r["doc_id"], r["text"]) for r in before]
    groups = [c for _, c in test_jaccard.brute(pairs, 5, 80)]
    worded = [bool(test_jaccard.shingles(t, 5)) for _, t in pairs]
    want = {g for g, w in zip(groups, worded, strict=True) if w}
    assert Counter(r["doc_id"] for r in after if test_jaccard.shingles(r["text"], 5)) == Counter(want)
    assert not counted(after) - counted(before)
    assert sum(not test_jaccard.shingles(r["text"], 5) for r in after) == worded.count(False)

    before, after = results["personal_data"]
    field = pii.fit(spark.createDataFrame([(r["text"],) for r in before], "text string"), str(tmp_path / "field"))
    want = []
    for r in before:
        spans = pii.all_spans(r["text"] or "", field)[1]
        text = pii.redacted(r["text"], spans) if spans else r["text"]
        want.append({**r, "text": text, "n_chars": len(text) if spans else r["n_chars"]})
    assert counted(after) == counted(want)
    assert not any(pii.base_spans(r["text"] or "") for r in after)

    before, after = results["packing"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r["doc_id"]: test_tokens.ids_of(library, r["text"] or "", [0]) for r in before}
    test_tokens.check_pieces(spark.read.parquet(str(tmp_path / "packing")).collect(), ids)
    return results


def test_stages_and_run(spark, tmp_path):
    docs = ready(spark).read.parquet(f"{SMALL}/documents.parquet")
    results = check_stages(spark, docs, tmp_path)
    assert 0 < len(results["personal_data"][1]) < docs.count()
    whole = corpus_pipeline.run(spark, SMALL).select("doc_id", "start", "doc_tokens", F.octet_length("ids"))
    kept = Counter((r["doc_id"], r["doc_tokens"]) for r in results["packing"][1])
    assert {r.doc_id for r in whole.collect()} == {d for d, _ in kept}


def test_stages_with_odd_documents(spark, tmp_path):
    rows, chance = edges.rows(), edges.random.Random(5)
    prose = [" ".join(chance.choice(["the", "of", "thand", "erea", "in,"]) for _ in range(60)) for _ in range(6)]
    lined = "\n".join(f"line {i} of the common passage" for i in range(8))
    texts = [*prose, prose[0], prose[1] + " more", f"{lined}\nown end", f"other start\n{lined}", lined, prose[2] + " a@b.cd"]
    rows = [r for r in rows if r[0] != 5 and r[0] is not None][:40]
    rows = list({r[0]: r for r in rows}.values())
    rows += [(1000 + i, t, [None, "en", "xx"][i % 3], "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, edges.SCHEMA)
    docs = edges.clashing(docs, ["kept", "node", "gone", "document", "language", "kept_text", "place"]).repartition(3)
    check_stages(spark, docs, tmp_path)


def test_copies_alike_in_every_column_leave_one(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text)] * 3 + [(2, text), (None, text), (3, "")], "doc_id long, text string")
    left = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(1, text), (3, "")]
