"""Fill-in-middle against plain Python."""

from __future__ import annotations

import hashlib
from collections import Counter

import edges
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tillwarden.llm import fill_middle, queries
from tillwarden.llm.common import ready


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc_id, text, forms=fill_middle.Forms()):
    text = text or ""
    units = [x + "\n" for x in text.split("\n")]
    units[-1] = units[-1][:-1]
    units = [u for u in units if u]
    digest = sha(f"{forms.seed}:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= forms.percent:
        return n, "plain", None, None, text
    i, j = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    if h[3] % 100 < forms.spm_percent:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_op11_equals_plain_python(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = queries.QUERIES["op11_fill_in_middle"](spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        n, form, p, m, output = plain(r.doc_id, texts[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, p, m)
        assert (r.output_sha256, r.restored_sha256) == (sha(output), sha(texts[r.doc_id] or ""))
    assert {r.form for r in got} >= {"psm", "spm"}


MARKED = ["has <P> in it\nand more", "<S>", "a\nb<M>", "<P", "S>\n<S", "M>M>\n\n<M\n>", "🙂\né\n\n\nx", "\n", "a", "\r\n\x0b\x85\u2028\n"]


def test_op11_edges(spark):
    rows = [*edges.rows(), *[(500 + i, t, None, None, None) for i, t in enumerate(MARKED)]]
    docs = spark.createDataFrame(rows, edges.SCHEMA).repartition(3)
    docs = edges.clashing(ready(spark) and docs, ["n", "form", "output", "h1", "h2", "prefix_chars"])
    for forms in (fill_middle.Forms(), fill_middle.Forms(percent=50, spm_percent=90, seed=3)):
        made = fill_middle.fill_in_middle(docs, forms)
        back = fill_middle.restored(F.col("form"), F.col("output"), forms)
        got = made.select("*", back.alias("back")).collect()
        want = Counter((r[0], *plain(r[0], r[1], forms), r[1] or "") for r in rows)
        assert Counter(tuple(r) for r in got) == want
    assert fill_middle.fill_in_middle(docs.limit(0)).count() == 0


def test_op11_other_units_and_marks(spark):
    forms = fill_middle.Forms(unit=r"\S++\s*+|\s++", prefix="[pre]", suffix="[suf]", middle="[mid]")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(edges.texts())], "doc_id long, text string")
    made = fill_middle.fill_in_middle(docs, forms).join(docs, "doc_id")
    back = fill_middle.restored(F.col("form"), F.col("output"), forms)
    assert made.where(back != F.coalesce("text", F.lit(""))).count() == 0
    assert made.where("n > 3 and middle_chars > 0").count() > 50
    for bad in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("ab", "bc", "<M>"), ("<a>", "a", "<M>")):
        with pytest.raises(ValueError):
            fill_middle.Forms(prefix=bad[0], suffix=bad[1], middle=bad[2])


def test_op11_very_long_texts():
    """Runs of units give the ends that one match gives; memory of a match is bounded."""
    unit = fill_middle.Forms().unit
    short, whole = fill_middle.Units(unit, held=3), fill_middle.Units(unit)
    for text in [t or "" for t in edges.texts()] + MARKED:
        assert short.ends(text) == whole.ends(text)
    long = "ab\n\n" * 700_000 + "tail"
    ends = whole.ends(long)
    assert len(ends) == 1_400_001 and ends[-1] == len(long) and ends[:3] == [3, 4, 7]
    with pytest.raises(ValueError):
        fill_middle.Units("[a-z]").ends("ab1")
