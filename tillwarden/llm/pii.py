"""Personal data: base patterns, and a semi-Markov conditional random field over spans.

The base finds e-mail addresses, IP addresses, payment cards and phone numbers by
rule. The field looks at stretches of words that hold digits or an at sign: every
run of up to ``LONGEST`` words is a candidate for every kind, scored by features
of the whole span and by the kind before it, and dynamic programming chooses the
cuts and kinds of a stretch together. It learns from what the base finds in a
bounded sample, and adds spans that are alike in form where the base has none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwarden.operators.lookup import stage

KINDS = ["email", "ip", "card", "phone"]
# Texts without any of these characters hold neither base spans nor candidates.
GATE = "[0-9@]"

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match never starts inside a run of digits: what fails or fits at its start
# does so at every place in it. This keeps long runs linear.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def octets(text: str) -> bool:
    """Whether every part between dots is a number up to 255."""
    parts = [p.lstrip("0") for p in text.split(".")]
    return all(len(p) <= 3 and (not p or int(p) <= 255) for p in parts)


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign to the left as far as a name goes, to the right a domain."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            free = found.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """Every span of the base, by start, then kind; of each kind leftmost and apart."""
    found = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if "." in text:
        found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if octets(m.group())]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = only_digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(only_digits(m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


# The field: stretches of words, candidate spans, features.

NEAR = re.compile(r"[0-9@]")
LONGEST = 4
# A word longer than this is no personal data of these kinds, but what stands between
# marks inside it may be: fields of data without spaces, parts of an address.
LONG_WORD = 80
BETWEEN = ",;:\"'`{}[]()<>=|&?/\\"
WORD = re.compile(rf"\S{{1,{LONG_WORD + 1}}}")
PART = re.compile(rf"[^\s{re.escape(BETWEEN)}]{{1,{LONG_WORD + 1}}}")
EDGE = "\"'`.,;:!?<>[]{}|*#&%$"
LABELS = 1 + len(KINDS)  # 0: none


@dataclass(frozen=True)
class Learning:
    """``sample`` bounds the texts the field learns from, ``longest`` their characters,
    ``stretches`` those of one text and ``words`` the words of a stretch: what is beyond teaches nothing.

    ``margin`` is by how much a span's score must exceed that of no span.
    """

    sample: int = 2000
    longest: int = 50_000
    stretches: int = 20
    words: int = 50
    epochs: int = 8
    rate: float = 0.3
    margin: float = 4.0
    seed: int = 5


def stretches(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of neighbouring words that hold a digit or an at sign, without edge marks.

    Of a long word each part between marks is a run of its own.
    """
    run, last = [], -1

    def around(at: int, ends: str, whole: re.Pattern) -> tuple[int, int]:
        a = at
        while a > 0 and not text[a - 1].isspace() and text[a - 1] not in ends and at - a <= LONG_WORD:
            a -= 1
        return a, whole.match(text, at).end()

    for mark in NEAR.finditer(text):
        if mark.start() < last:
            continue
        a, b = around(mark.start(), "", WORD)
        if b - a > LONG_WORD:
            a, b = around(mark.start(), BETWEEN, PART)
        near = run and text[last:a].strip() == "" and a - last <= 2
        last = b
        word = text[a:b]
        a += len(word) - len(word.lstrip(EDGE))
        b -= len(word) - len(word.rstrip(EDGE))
        if run and (not near or b - a > LONG_WORD):
            yield run
            run = []
        if 0 < b - a <= LONG_WORD:
            run.append((a, b))
    if run:
        yield run


NAMES = [
    "bias", "at", "domain", "dots3", "octets", "octets_bad", "plus", "parens", "hyphen",
    "digits_7_9", "digits_10_13", "digits_14_19", "digits_other", "luhn", "luhn_bad", "letters",
    "hex_like", "words_1", "words_2", "words_3", "other_marks", "grouped",
]


def features(span: str, words: int) -> list[float]:
    """What a candidate span looks like as a whole."""
    digits = only_digits(span)
    n = len(digits)
    letters = sum(c.isalpha() for c in span)
    at = span.count("@")
    dots3 = n > 0 and letters == 0 and re.fullmatch(r"[0-9]+(\.[0-9]+){3}", span) is not None
    plain = letters == 0 and at == 0
    number = plain and re.fullmatch(r"[0-9]([ -]?[0-9])+", span) is not None
    right = number and 14 <= n <= 19
    odd = sum(not (c.isalnum() or c in " @.+-()_%") for c in span)
    return [
        float(x)
        for x in (
            1,
            at == 1 and words == 1,
            at == 1 and DOMAIN.fullmatch(span[span.find("@") + 1 :]) is not None,
            dots3,
            dots3 and octets(span),
            dots3 and not octets(span),
            span.startswith("+"),
            "(" in span and ")" in span,
            plain and "-" in span,
            plain and 7 <= n <= 9,
            plain and 10 <= n <= 13,
            plain and 14 <= n <= 19,
            plain and not 7 <= n <= 19,
            right and luhn(digits),
            right and not luhn(digits),
            letters > 0 and at == 0,
            letters > 0 and n > letters,
            words == 1,
            words == 2,
            words == 3,
            odd > 0,
            plain and n >= 7 and any(c in span for c in " -()"),
        )
    ]


def candidates(text: str, run: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Places (first word, words) and features of all spans of up to ``LONGEST`` words."""
    places = [(i, k) for i in range(len(run)) for k in range(1, min(LONGEST, len(run) - i) + 1)]
    rows = [features(text[run[i][0] : run[i + k - 1][1]], k) for i, k in places]
    return places, np.array(rows)


class Field:
    """Weights of features by label, and of a label after a label."""

    def __init__(self, weights: np.ndarray, steps: np.ndarray):
        self.weights, self.steps = weights, steps

    @classmethod
    def empty(cls) -> Field:
        return cls(np.zeros((len(NAMES), LABELS)), np.zeros((LABELS, LABELS)))

    def scores(self, places, rows) -> np.ndarray:
        """Score of each candidate under each label; only single words can be none."""
        found = rows @ self.weights
        found[[k > 1 for _, k in places], 0] = -np.inf
        return found

    def best(self, places, scores, size: int) -> list[tuple[int, int, int, float]]:
        """The cuts and kinds of the highest total: (first word, words, kind, lead).

        ``lead`` is how much the span scores above its words being none. Work is
        linear in the words of the stretch: spans are bounded.
        """
        top = np.full((size + 1, LABELS), -np.inf)
        top[0, 0] = 0.0
        back: dict[tuple[int, int], tuple[int, int, int]] = {}
        at = {p: j for j, p in enumerate(places)}
        for end in range(1, size + 1):
            for k in range(1, min(LONGEST, end) + 1):
                own = scores[at[end - k, k]]
                reached = top[end - k][:, None] + self.steps + own[None, :]
                before = reached.argmax(axis=0)
                for label in range(LABELS):
                    value = reached[before[label], label]
                    if value > top[end, label]:
                        top[end, label] = value
                        back[end, label] = (end - k, int(before[label]), k)
        found, end, label = [], size, int(top[size].argmax())
        while end > 0:
            start, before, k = back[end, label]
            if label:
                none = sum(scores[at[i, 1]][0] for i in range(start, end))
                found.append((start, k, label - 1, float(scores[at[start, k]][label] - none)))
            end, label = start, before
        return found[::-1]

    def learn(self, places, rows, size: int, gold: dict[int, tuple[int, int]], rate: float) -> None:
        """One step up the log-likelihood: features of the gold cuts less the expected ones.

        ``gold`` has the words and label of each gold span by its first word.
        """
        scores = self.scores(places, rows)
        at = {p: j for j, p in enumerate(places)}
        forward = np.full((size + 1, LABELS), -np.inf)
        forward[0, 0] = 0.0
        for end in range(1, size + 1):
            parts = [
                forward[end - k][:, None] + self.steps + scores[at[end - k, k]][None, :]
                for k in range(1, min(LONGEST, end) + 1)
            ]
            forward[end] = np.logaddexp.reduce(np.vstack(parts), axis=0)
        backward = np.full((size + 1, LABELS), -np.inf)
        backward[size] = 0.0
        for start in range(size - 1, -1, -1):
            parts = [
                self.steps + (scores[at[start, k]] + backward[start + k])[None, :]
                for k in range(1, min(LONGEST, size - start) + 1)
            ]
            backward[start] = np.logaddexp.reduce(np.hstack(parts), axis=1)
        total = np.logaddexp.reduce(forward[size])
        down, down_steps = np.zeros_like(self.weights), np.zeros_like(self.steps)
        for j, (i, k) in enumerate(places):
            share = np.exp(
                forward[i][:, None] + self.steps + scores[j][None, :] + backward[i + k][None, :] - total
            )
            down_steps += share
            down += np.outer(rows[j], share.sum(axis=0))
        i, before = 0, 0
        while i < size:
            k, label = gold.get(i, (1, 0))
            down[:, label] -= rows[at[i, k]]
            down_steps[before, label] -= 1
            i, before = i + k, label
        self.weights -= rate * (down + 1e-3 * self.weights)
        self.steps -= rate * (down_steps + 1e-3 * self.steps)


def gold_spans(run: list[tuple[int, int]], spans: list[Span]) -> dict[int, tuple[int, int]] | None:
    """The base's spans as runs of words; None if one lies across the words' bounds."""
    starts = {a: i for i, (a, _) in enumerate(run)}
    ends = {b: i for i, (_, b) in enumerate(run)}
    gold, last = {}, -1
    for a, kind, b in spans:
        if b <= run[0][0] or a >= run[-1][1]:
            continue
        i, j = starts.get(a), ends.get(b)
        if i is None or j is None or j - i >= LONGEST or i <= last:
            return None
        gold[i], last = (j - i + 1, kind + 1), j
    return gold


def train(texts: list[str], how: Learning) -> Field:
    examples = []
    for text in texts:
        spans = base_spans(text)
        for n, run in enumerate(stretches(text)):
            if n == how.stretches:
                break
            run = run[: how.words]
            gold = gold_spans(run, spans)
            if gold is not None:
                examples.append((*candidates(text, run), len(run), gold))
    field, chance = Field.empty(), np.random.default_rng(how.seed)
    steps, step = how.epochs * len(examples), 0
    for _ in range(how.epochs):
        for e in chance.permutation(len(examples)):
            places, rows, size, gold = examples[e]
            field.learn(places, rows, min(size, len(rows)), gold, how.rate * (1 - step / steps))
            step += 1
    return field


def _train(table: pa.Table, how: Learning) -> pa.Table:
    rows = sorted(zip(table.column("turn").to_pylist(), table.column("text").to_pylist(), strict=True))
    field = train([t for _, t in rows], how)
    numbers = [*field.weights.ravel().tolist(), *field.steps.ravel().tolist()]
    return pa.table({"numbers": pa.array([numbers], pa.list_(pa.float64()))})


def fit(docs: DataFrame, folder: str, how: Learning = Learning()) -> Field:
    """Learn from at most ``how.sample`` different texts with a digit or an at sign, by smallest hash.

    Hashes are chosen first, so that copies teach once and only chosen texts are
    sent on. These go to one task, which their number and ``how.longest`` bound;
    without any, the field adds nothing.
    """
    texts = docs.select(F.col("text").cast("string").alias("text")).where(F.col("text").rlike(GATE))
    texts = texts.where(F.length("text") <= how.longest).withColumn("turn", F.xxhash64("text"))
    chosen = texts.select("turn").distinct().orderBy("turn").limit(how.sample)
    chosen = stage(chosen, f"{folder}/chosen")
    sample = texts.join(F.broadcast(chosen), "turn").groupBy("turn").agg(F.min("text").alias("text"))
    sample = stage(sample.select("text", "turn"), f"{folder}/sample")
    together = sample.withColumn("field", F.lit(1)).groupBy("field")

    def one(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _train(table, how)

    row = stage(together.applyInArrow(one, "numbers array<double>"), f"{folder}/field").first()
    if row is None:
        return Field.empty()
    numbers, cut = np.array(row.numbers), len(NAMES) * LABELS
    return Field(numbers[:cut].reshape(-1, LABELS), numbers[cut:].reshape(LABELS, LABELS))


def all_spans(text: str, field: Field, how: Learning = Learning()) -> tuple[list[Span], list[Span]]:
    """The base's spans, and these with what the field adds apart from them."""
    base = base_spans(text)
    added = []
    for run in stretches(text):
        places, rows = candidates(text, run)
        for first, words, kind, lead in field.best(places, field.scores(places, rows), len(run)):
            a, b = run[first][0], run[first + words - 1][1]
            if lead >= how.margin and all(b <= s or a >= e for s, _, e in base):
                added.append((a, kind, b))
    return base, sorted([*base, *added])


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping ones, replaced by its first kind."""
    parts, done = [], 0
    for a, kind, b in spans:
        if a >= done:
            parts += [text[done:a], f"[{KINDS[kind].upper()}]"]
        done = max(done, b)
    return "".join([*parts, text[done:]])


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base string, spans string, clean string"


def finder(field: Field):
    """A column function: counts, spans and redacted text of each text that may hold any."""

    @F.pandas_udf(FOUND)
    def find(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            if text is None:
                rows.append((0, 0, 0, 0, "", "", None))
                continue
            base, spans = all_spans(text, field)
            counts = [sum(k == kind for _, k, _ in base) for kind in range(4)]
            rows.append((*counts, written(base), written(spans), redacted(text, spans) if spans else None))
        return pd.DataFrame(rows, columns=[part.split()[0] for part in FOUND.split(", ")])

    return find


def found_in(text: Column, field: Field) -> Column:
    """The struct of :func:`finder` for a text column; texts that pass no gate stay in the JVM."""
    return finder(field)(F.when(text.rlike(GATE), text))


def personal_data(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id``, counts of the base, ``base`` and ``spans`` of every row.

    Spans are ``kind:start:end`` in code points, by start, then kind. Null and
    empty texts have none. Every text is searched whole, in time linear in its
    length. Repeated rows and null ids are kept; other columns are not read.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), found_in(text, field).alias("f"))
    names = ("n_email", "n_ip", "n_card", "n_phone", "base", "spans")
    return rows.select("doc_id", *[F.col("f")[n].alias(n) for n in names])


def redact(docs: DataFrame, field: Field) -> DataFrame:
    """``docs`` with every span of its texts replaced by its kind; other texts as they were."""
    clean = found_in(F.col("text").cast("string"), field)["clean"]
    return docs.withColumn("text", F.coalesce(clean, F.col("text")))
