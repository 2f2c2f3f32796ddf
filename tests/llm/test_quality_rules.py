"""Quality rules and line dedup, against plain Python."""

from __future__ import annotations

import math
import re
from collections import Counter

import edges
from compare import connect, differences
from conftest import SMALL
from pyspark.sql import functions as F

from tillwarden.llm import line_dedup, quality_rules, queries
from tillwarden.llm.common import ready
from tillwarden.operators.lookup import stage


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 8))
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def judged(spark, docs, tmp_path, **kinds):
    rows, q = quality_rules.measured(docs)
    return quality_rules.judge(rows, q, str(tmp_path / "references"), **kinds)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_op9_counts_and_base(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = queries.QUERIES["op9_quality_rules"](spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        want = counts(texts[r.doc_id] or "")
        assert tuple(r[c] for c in COUNTS) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.kept and r.base_failed)


def test_op9_tells_junk_from_prose(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = queries.QUERIES["op9_quality_rules"](spark, "/root/testdata/sf0.01").join(labels, "doc_id")
    share = {r.quality: r.share for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] > 0.96 and share[0] < 0.2


def test_op9_edges(spark, tmp_path):
    docs = edges.clashing(edges.frame(ready(spark)), ["_q", "_words", "kept", "n_words", "_language"])
    got = judged(spark, docs, tmp_path)
    assert [c for c in got.columns if c in ("doc_id", "text", "_words")] == ["doc_id", "text", "_words"]
    want = Counter((r[0], r[1], *counts(r[1] or "")) for r in edges.rows())
    assert Counter((r.doc_id, r.text, *[r[c] for c in COUNTS]) for r in got.collect()) == want
    none = judged(spark, docs.limit(0), tmp_path / "none", language=None)
    assert none.count() == 0


def test_op9_distance(spark):
    own, reference = [3, 1, 0, 0, 4], [1, 1, 1, 0, 7]
    row = spark.range(1).select(
        quality_rules._distance(
            *[F.array(*[F.lit(x).cast("long") for x in a]) for a in (own, reference)], 5
        ).alias("d")
    )
    p, r = [x / 8 for x in own], [x / 10 for x in reference]
    want = sum(
        a / 2 * math.log2(2 * a / (a + b)) for x, y in zip(p, r, strict=True) for a, b in ((x, y), (y, x)) if a
    )
    assert abs(row.first().d - math.sqrt(want)) < 1e-9


def test_op9_documents_without_a_reference(spark, tmp_path):
    """Clean texts stay and junk goes whether the language is null or rare, in small and large tables."""
    hidden = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    kinds = {
        "null": F.when(~hidden, F.col("lang")),
        "rare": F.when(~hidden, F.col("lang")).otherwise(F.concat(F.lit("x"), F.col("doc_id") % 100)),
        "all_null": F.lit(None).cast("string"),
    }
    for size in ("sf0.001", "sf0.01"):
        docs = ready(spark).read.parquet(f"/root/testdata/{size}/documents.parquet").select("doc_id", "text", "lang")
        quality = {r.doc_id: r.quality for r in spark.read.parquet(f"/root/testdata/{size}/labels.parquet").collect()}
        rows, q = quality_rules.measured(docs)
        rows = stage(rows.drop("text"), str(tmp_path / size))
        for kind, lang in kinds.items():
            marked = rows.select("doc_id", lang.alias("lang"), hidden.alias("hidden"), q)
            got = quality_rules.judge(marked, q, str(tmp_path / f"{size}_{kind}")).collect()
            got = [r for r in got if r.hidden or size == "sf0.001" or r.lang is None]
            clean = [r for r in got if quality.get(r.doc_id) == 1 and r.n_words >= 50 and not r.base_failed]
            assert len(clean) > 10 and sum(not r.kept for r in clean) <= len(clean) / 100, (size, kind)
            junk = [r.kept for r in got if quality.get(r.doc_id) == 0]
            assert kind != "null" or sum(junk) < len(junk) * 0.4, (size, kind)


def test_op9_a_language_of_its_own_hides_no_junk(spark, tmp_path):
    """Junk of languages that nobody else writes goes as it does under its real one."""
    docs = ready(spark).read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality")
    rows, q = quality_rules.measured(docs.join(labels, "doc_id", "left"))
    rows = stage(rows.drop("text"), str(tmp_path / "rows"))
    own = F.when(F.col("quality") == 0, F.concat(F.lit("own"), F.col("doc_id"))).otherwise(F.col("lang"))
    kept = {}
    for kind, lang in (("real", F.col("lang")), ("own", own)):
        got = quality_rules.judge(rows.withColumn("lang", lang), q, str(tmp_path / kind)).where("quality = 0")
        kept[kind] = {r.doc_id for r in got.where("kept").collect()}
    assert len(kept["own"]) <= len(kept["real"]) + 1, kept


def test_op9_bounds_are_fields(spark, tmp_path):
    """Only the largest references are compared with; a text is no reference of itself."""
    words = {"a": "the of and " * 40, "b": "der die und " * 40, "c": "zz yy xx " * 40}
    texts = [(f"{k} {i}", k * (n > 1), w + f" w{i}") for k, w, n in (("a", words["a"], 7), ("b", words["b"], 6), ("c", words["c"], 1)) for i in range(n)]
    texts += [("lone", "q", words["c"] * 2), ("lone a", "r", words["a"])]
    rows, q = quality_rules.measured(spark.createDataFrame(texts, "doc_id string, lang string, text string"))
    loose = quality_rules.QualityRules(repeat_percent=1000, reference_documents=5)
    got = {r.doc_id: r.word_distance for r in quality_rules.judge(rows, q, str(tmp_path / "all"), loose).collect()}
    assert got["a 0"] < 0.1 and got["b 0"] < 0.1 and got["lone a"] < 0.1 and got["lone"] > 0.5 and got["c 0"] > 0.5
    one = quality_rules.QualityRules(repeat_percent=1000, reference_documents=5, languages=1)
    got = {r.doc_id: r.word_distance for r in quality_rules.judge(rows, q, str(tmp_path / "one"), one).collect()}
    assert got["lone a"] < 0.1 and got["b 0"] > 0.5
    many = quality_rules.QualityRules(repeat_percent=1000, reference_documents=7)
    got = {r.doc_id: r.word_distance for r in quality_rules.judge(rows, q, str(tmp_path / "many"), many).collect()}
    assert got["a 0"] == 0 and got["b 0"] > 0.5 and got["lone a"] < 0.1


def removed(rows):
    """Plain line dedup: (id, text) to the text that is kept."""
    alike, seen, kept = {}, {}, {}
    for doc_id, text in rows:
        alike.setdefault((doc_id, text), None)
    for doc_id, text in alike:
        lines = (text or "").split("\n")
        gone = set()
        for i in range(max(1, len(lines) - 2)):
            window = tuple(lines[i : i + 3])
            if not re.search(r"[^ \t\r\n\v\f]", "".join(window)):
                continue
            if window in seen:
                gone.update(range(i, i + len(window)))
            seen.setdefault(window, (doc_id, i))
        kept[doc_id, text] = (
            len(lines),
            len(gone),
            "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text,
        )
    return kept


def test_op10_equals_sql(spark):
    name = "op10_line_dedup"
    got = queries.QUERIES[name](spark, SMALL)
    assert differences(got, connect(SMALL), queries.ORACLE[name]) == []
    assert got.where("n_removed > 0").count() > 0


def test_op10_overlaps_and_edges(spark, tmp_path):
    texts = [
        "a\nb\nc\nd\nown",
        "x\na\nb\nc\nd\ny",
        "a\na\na\na\na",
        "a\na\na",
        "b\nc",
        None,
        "",
        "\n\n\n\n",
        "same\nsame\nq\nsame\nsame\nq",
        "a\nb\nc\nd\nown",
        *edges.texts()[10:60],
    ]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[1], (None, "k")], "doc_id long, text string").repartition(3)
    docs = edges.clashing(docs, ["gone", "doc", "own", "n_removed", "line"])
    got = line_dedup.dedup_lines(docs, folder=str(tmp_path / "lines"))
    want = removed([(None, "k"), *rows])
    found = [(r.doc_id, r.text, r.n_lines, r.n_removed, r.kept_text) for r in got.collect()]
    assert len(found) == len(rows) + 2
    for doc_id, text, *rest in found:
        assert tuple(rest) == want[doc_id, text], (doc_id, text)
    assert want[1, texts[1]][2] == "x\ny" and want[9, texts[9]][2] == ""
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_op10_short_texts_are_windows(spark):
    texts = ["one line", "two\nlines", "one line", "two\nlines", "two", "lines", "one line\n", "one line\n", " ", " ", "a\nb\nc", "b\nc", "a\nb\nc"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.kept_text) for r in line_dedup.dedup_lines(docs).collect()}
    whole = {2: 1, 3: 2, 7: 2, 12: 3}
    assert got == {i: (whole[i], "") if i in whole else (0, t) for i, t in enumerate(texts)}


def test_op10_is_linear_in_lines(spark):
    """Ten times the lines of a text of equal lines take far less than a hundred times as long."""
    import time

    def seconds(n):
        docs = spark.createDataFrame([(1, "\n".join(["same line"] * n))], "doc_id long, text string")
        started = time.perf_counter()
        row = line_dedup.dedup_lines(docs).select("n_removed", F.length("kept_text").alias("left")).first()
        # The first window stays, but for its lines that the second covers.
        assert (row.n_removed, row.left) == (n - 1, 9)
        return time.perf_counter() - started

    seconds(100)
    few = seconds(10_000)
    assert seconds(100_000) < 30 * max(few, 0.5)
