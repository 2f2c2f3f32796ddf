"""Fill-in-middle: a text cut into prefix, middle and suffix at unit ends, and put in another order.

One match of ``(unit)*`` over the whole text keeps every repetition of its
group: the ends of the group are the ends of all units, so their number and both
cuts are looked up in them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwarden.llm.common import pieces_of, texts_of

CHUNK = 4 << 20
# Units one match may hold: the library keeps some 250 bytes for each while it matches.
UNITS_HELD = 200_000
LAYOUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
NAMES = [part.split()[0] for part in LAYOUT.split(", ")]


@dataclass(frozen=True)
class Forms:
    """How texts are cut and put together.

    ``unit``: what a text is cut into, matched from left to right; it must match
    any text in whole repetitions. ``prefix``, ``suffix``, ``middle``: the marks.
    ``percent`` of the texts are transformed, ``spm_percent`` of these with the
    suffix first. ``seed`` and the document's id decide for each text.
    """

    unit: str = r"[^\n]*+\n|[^\n]++"
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    percent: int = 100
    spm_percent: int = 50
    seed: int = 7

    def __post_init__(self):
        marks = self.marks
        if len(set(marks)) < 3 or not all(marks):
            raise ValueError("marks must differ and not be empty")
        for a in marks:
            for b in marks:
                overlap = any(a[-k:] == b[:k] for k in range(1, min(len(a), len(b))))
                if overlap or a != b and a in b:
                    raise ValueError("marks must not hold or overlap one another")

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers that follow from the seed and the id: groups of a digest. A null id counts as empty."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(name.cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


class Units:
    """The ends of all units of a text, from the captures one match retains.

    A text of more characters than one match may hold units is matched in runs of
    so many units; a unit is never given back, so the ends are the same.
    """

    def __init__(self, unit: str, held: int = UNITS_HELD):
        self.held = held
        self.whole = regex.compile(f"(?:({unit}))*+")
        self.run = regex.compile(f"(?:({unit})){{1,{held}}}+")

    def ends(self, text: str) -> list[int]:
        if len(text) <= self.held:
            found = self.whole.fullmatch(text)
            if found is None:
                raise ValueError("the unit does not match the whole text")
            return found.ends(1)
        ends, at = [], 0
        while at < len(text):
            found = self.run.match(text, at)
            if found is None or found.end() == at:
                raise ValueError("the unit does not match the whole text")
            ends += found.ends(1)
            at = found.end()
        return ends


def arrange(text: str, h: tuple[int, int, int, int], forms: Forms, units: Units) -> tuple:
    """Number of units, form, code points of prefix and middle, and the output of one text."""
    ends = units.ends(text)
    n = len(ends)
    if not text or any(m in text for m in forms.marks) or h[2] % 100 >= forms.percent:
        return n, "plain", None, None, text
    cuts = [0, 0]
    for i, draw in enumerate(h[:2]):
        k = draw % (n + 1)
        cuts[i] = ends[k - 1] if k else 0
    a, b = sorted(cuts)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < forms.spm_percent:
        form = "spm"
        output = f"{forms.suffix}{suffix}{forms.prefix}{prefix}{forms.middle}{middle}"
    else:
        form = "psm"
        output = f"{forms.prefix}{prefix}{forms.suffix}{suffix}{forms.middle}{middle}"
    return n, form, a, b - a, output


def _arrange(batches: Iterator[pa.RecordBatch], forms: Forms) -> Iterator[pa.RecordBatch]:
    units = Units(forms.unit)
    for batch in batches:
        texts, keys = texts_of(batch), batch.column("doc_id").to_pylist()
        h = list(zip(*[batch.column(f"h{k}").to_pylist() for k in range(1, 5)], strict=True))
        for a, b in pieces_of([len(t) for t in texts], CHUNK):
            rows = [(k, *arrange(t, d, forms, units)) for k, t, d in zip(keys[a:b], texts[a:b], h[a:b], strict=True)]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), KINDS, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=NAMES)


def fill_in_middle(docs: DataFrame, forms: Forms = Forms()) -> DataFrame:
    """``doc_id``, number of units ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output`` per row.

    Each row is transformed by itself: nothing is shuffled, and a task that runs
    again gives the same rows. ``form`` is ``psm``, ``spm``, or ``plain`` for texts
    left as they are: null (as empty) and empty ones, those that hold a mark, and
    those not drawn; the two lengths, in code points, are null then. Very long texts are cut
    like others, with one number kept per unit. Repeated rows are transformed each
    and alike; a null id draws as an empty one; no rows give no rows. Other
    columns of ``docs`` are not read.
    """
    key = F.col("doc_id").cast("long")
    rows = docs.select(key.alias("doc_id"), F.col("text").cast("string").alias("text"), *draws(key, forms.seed))
    return rows.mapInArrow(partial(_arrange, forms=forms), LAYOUT)


def restored(form: Column, output: Column, forms: Forms = Forms()) -> Column:
    """The text that gave ``output``; null where either is null. Marks are in it once each, or it is plain."""

    def part(after: str, before: str | None) -> Column:
        tail = F.substring_index(output, after, -1)
        return F.substring_index(tail, before, 1) if before else tail

    psm = F.concat(part(forms.prefix, forms.suffix), part(forms.middle, None), part(forms.suffix, forms.middle))
    spm = F.concat(part(forms.prefix, forms.middle), part(forms.middle, None), part(forms.suffix, forms.prefix))
    return F.when(form == "psm", psm).when(form == "spm", spm).when(form == "plain", output)
