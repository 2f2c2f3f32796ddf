"""Quality rules: counts, and how far a text's characters and common words are from its language's.

Each text gets a histogram of character classes and one of common words. The
reference of a language is the sum of the histograms of its documents, less the
text that is judged; the Jensen-Shannon distance between a text and the
reference of its language tells unusual texts; where its language is not known or
rare, the smallest distance to any language's reference does. Texts too short for a
histogram are not judged by it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwarden.llm.common import fresh, hint_if_small
from tillwarden.operators.lookup import stage

BLANKS = " \t\n\x0b\x0c\r"
# Frequent short words of English, German, French and Spanish.
COMMON_WORDS = ["the", "of", "and", "to", "in", "is", "der", "die", "das", "und", "le", "les", "et", "que", "de", "la", "el", "los", "en", "y"]
SYMBOLS = "#*$%&|<>"
REPEAT = 8


@dataclass(frozen=True)
class QualityRules:
    """Thresholds of the rules.

    ``min_words``, ``repeat_percent``: the base rules. ``char_distance`` and
    ``word_distance``: the largest Jensen-Shannon distances (0 to 1) that are
    kept; of labelled prose, 99 in 100 lie below 0.16 and 0.19. With fewer words
    than ``guard_words`` neither decides, with fewer than ``word_guard`` the
    characters alone do. A language is a reference if it has ``reference_documents``
    other documents; by it alone is judged what is in it if these have
    ``reference_words`` words. Texts without such a language are compared with the
    ``languages`` largest references.
    """

    min_words: int = 20
    repeat_percent: int = 30
    guard_words: int = 50
    word_guard: int = 100
    char_distance: float = 0.25
    word_distance: float = 0.22
    reference_words: int = 10_000
    reference_documents: int = 5
    languages: int = 1000


def _words(text: Column) -> Column:
    return F.filter(F.split(text, "[ \t-\r]+", -1), lambda w: w != "")


def measured(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a struct of the counts and histograms of each text, and its name.

    Everything is computed inside the row: nothing is exploded or shuffled.
    Windows are compared by hash. Places of repeated windows are put in order;
    each adds eight words less what it shares with the next.
    """
    text, words, hashes, keys, pairs, places = (
        fresh(n, docs) for n in ("_text", "_words", "_hashes", "_keys", "_pairs", "_places")
    )
    body, out = F.coalesce(F.col("text").cast("string"), F.lit("")), fresh("_q", docs)
    rows = docs.withColumn(text, body).withColumn(words, _words(F.col(text)))
    long = F.size(words) > REPEAT
    rows = rows.withColumn(
        hashes, F.when(long, F.transform(words, lambda w: F.xxhash64(w)))
    )
    window = F.transform(
        F.sequence(F.lit(1), F.size(words) - (REPEAT - 1)),
        lambda i: F.xxhash64(*[F.get(hashes, i + (k - 1)) for k in range(REPEAT)]),
    )
    rows = rows.withColumn(keys, F.when(long, window))
    # Only texts with a repeated window sort their windows.
    again = F.size(F.array_distinct(keys)) < F.size(keys)
    pair = F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    rows = rows.withColumn(pairs, F.when(again, F.sort_array(pair)))
    same = lambda x, j: F.get(pairs, j)["h"] == x["h"]
    repeats = F.filter(
        pairs,
        lambda x, j: F.coalesce(same(x, j + 1), F.lit(False))
        | ((j > 0) & F.coalesce(same(x, F.greatest(j - 1, F.lit(0))), F.lit(False))),
    )
    rows = rows.withColumn(places, F.sort_array(F.transform(repeats, lambda x: x["i"])))
    shared = F.aggregate(
        F.transform(
            places,
            lambda p, j: F.least(F.coalesce(F.get(places, j + 1) - p, F.lit(REPEAT)), F.lit(REPEAT)),
        ),
        F.lit(0),
        lambda total, x: total + x,
    )
    worded = F.filter(F.split(F.col(text), "\n", -1), lambda x: F.length(F.trim(x, F.lit(BLANKS))) > 0)
    characters = F.length(F.array_join(F.col(words), "")).cast("long")
    count = lambda pattern: F.regexp_count(F.col(text), F.lit(pattern)).cast("long")
    rows = rows.withColumn(
        out,
        F.struct(
            F.size(words).cast("long").alias("n_words"),
            characters.alias("word_chars"),
            count("[#*$%&|<>]").alias("n_symbols"),
            worded.alias("worded"),
            F.coalesce(shared, F.lit(0)).cast("long").alias("n_repeat_words"),
            count("[0-9]").alias("digits"),
            count("[.,;:!?'\"()-]").alias("marks"),
            F.length(text).cast("long").alias("n_chars"),
            F.filter(F.transform(words, F.lower), lambda w: w.isin(COMMON_WORDS)).alias("common"),
        ),
    )
    q = F.col(out)
    chars, common = _histograms(q)
    small = F.struct(
        *[q[n].alias(n) for n in ("n_words", "word_chars", "n_symbols")],
        (F.size(q["worded"]) - F.size(F.array_distinct(q["worded"]))).cast("long").alias("n_dup_lines"),
        q["n_repeat_words"].alias("n_repeat_words"),
        F.array(*chars).alias("chars"),
        F.array(*common).alias("common"),
    )
    return rows.select(*docs.columns, small.alias(out)), out


def _histograms(q: Column) -> tuple[list[Column], list[Column]]:
    """Counts of character classes, and of the common words and all others."""
    letters = q["word_chars"] - q["n_symbols"] - q["digits"] - q["marks"]
    chars = [letters, q["digits"], q["marks"], q["n_symbols"], q["n_chars"] - q["word_chars"]]

    def times(word: str) -> Column:
        return F.size(F.filter(q["common"], lambda w: w == word)).cast("long")

    words = [times(w) for w in COMMON_WORDS]
    return chars, [*words, q["n_words"] - F.size(q["common"])]


BINS = {"chars": 5, "common": len(COMMON_WORDS) + 1}


def _distance(own: Column, reference: Column, bins: int) -> Column:
    """Jensen-Shannon distance of two histograms, 0 to 1; 0 where one is empty."""

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x + y).cast("double")

    mine, theirs = total(own), total(reference)
    shares = F.zip_with(
        own, reference, lambda a, b: F.struct((a / mine).alias("p"), (b / theirs).alias("r"))
    )

    def term(x: Column, other: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + other))).otherwise(0.0) / 2

    found = F.aggregate(
        shares, F.lit(0.0), lambda t, s: t + term(s["p"], s["r"]) + term(s["r"], s["p"])
    )
    return F.when((mine > 0) & (theirs > 0), F.sqrt(F.greatest(found, F.lit(0.0)))).otherwise(0.0)


def references(rows: DataFrame, q: str, language: str | None) -> DataFrame:
    """The sum of the histograms of each language's documents and their number, one row per language.

    A language is merged in every task before the shuffle, however many
    documents it has.
    """
    key = F.col(language).cast("string") if language else F.lit("all")
    sums = [
        F.sum(F.get(F.col(q)[name], F.lit(k))).alias(f"{name}_{k}")
        for name, bins in BINS.items()
        for k in range(bins)
    ]
    found = rows.groupBy(key.alias("language")).agg(F.count("*").alias("documents"), *sums)
    bins = [F.array(*[f"{name}_{k}" for k in range(n)]).alias(name) for name, n in BINS.items()]
    return found.select("language", "documents", *bins)


def _less(reference: Column, own: Column) -> Column:
    return F.zip_with(reference, own, lambda a, b: a - b)


def _nearest(own: Column, language: Column, name: str, listed: list[dict]) -> Column:
    """The smallest distance to the listed references, without the text itself; 0 where there is none."""
    layout = "array<struct<language:string,few:boolean,bins:array<bigint>>>"
    known = F.from_json(F.lit(json.dumps([{**r, "bins": r[name]} for r in listed])), layout)

    def distance(r: Column) -> Column:
        mine = r["language"].eqNullSafe(language)
        apart = F.when(mine, _less(r["bins"], own)).otherwise(r["bins"])
        return F.when(~(mine & r["few"]), _distance(own, apart, BINS[name]))

    return F.coalesce(F.array_min(F.transform(known, distance)), F.lit(0.0))


def judge(
    rows: DataFrame,
    q: str,
    folder: str,
    rules: QualityRules = QualityRules(),
    language: str | None = "lang",
) -> DataFrame:
    """The rows of :func:`measured` with the counts, the distances, ``base_failed`` and ``kept``.

    ``rows`` should be a written table: it is read twice, once for the references
    of the languages, which cover all rows and are written to ``folder``. A text
    is never part of the reference it is compared with. One without a language, or
    of one whose other documents are too few (see :class:`QualityRules`), has the smallest
    distances to the references of all languages with enough other documents: a language
    nobody else writes keeps nothing. Only if there is no such reference are both
    distances 0. With ``language=None`` all rows count as one language. Null and
    empty texts have 0 words and fail; repeated rows and null ids are judged each; no
    rows give no rows. Columns that ``rows`` has under the new names are replaced.
    """
    sums = stage(references(rows, q, language), folder)
    total = lambda bins: F.aggregate(bins, F.lit(0).cast("long"), lambda a, b: a + b)
    named = sums.where(F.col("language").isNotNull() & (F.col("documents") >= rules.reference_documents))
    largest = named.orderBy(total(F.col("common")).desc(), "language").limit(rules.languages)
    # Without the text that is judged, a language may have one document too few.
    few = (F.col("documents") == rules.reference_documents).alias("few")
    listed = [r.asDict() for r in largest.select("language", few, *BINS).collect()]
    key, others, *refs = (fresh(n, rows) for n in ("_language", "_others", "_chars", "_common"))
    by_language = named.where(total(F.col("common")) >= rules.reference_words).select(
        F.col("language").alias(key),
        F.col("documents").alias(others),
        *[F.col(name).alias(c) for name, c in zip(BINS, refs, strict=True)],
    )
    # As many rows as languages: sent to all tasks only if that is a small number.
    by_language = hint_if_small(by_language, rules.languages)
    spoken = rows[language].cast("string") if language else F.lit("all")
    joined = rows.join(by_language, spoken == F.col(key), "left")
    own = {name: F.col(q)[name] for name in BINS}
    rest = {name: _less(F.col(c), own[name]) for name, c in zip(BINS, refs, strict=True)}
    enough = (F.col(others) > rules.reference_documents) & (total(rest["common"]) >= rules.reference_words)
    distances = {
        name: F.when(enough, _distance(own[name], rest[name], bins)).otherwise(
            _nearest(own[name], spoken, name, listed)
        )
        for name, bins in BINS.items()
    }
    n, repeats = F.col(q)["n_words"], F.col(q)["n_repeat_words"]
    results = {c: F.col(q)[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines")}
    results["n_repeat_words"] = repeats
    results["char_distance"], results["word_distance"] = distances["chars"], distances["common"]
    results["base_failed"] = (n < rules.min_words) | (100 * repeats > rules.repeat_percent * n)
    left = [c for c in rows.columns if c != q and c.lower() not in results]
    judged = joined.select(*left, *[c.alias(name) for name, c in results.items()])
    n = F.col("n_words")
    usual = (n < rules.guard_words) | (F.col("char_distance") <= rules.char_distance)
    worded = (n < rules.word_guard) | (F.col("word_distance") <= rules.word_distance)
    return judged.withColumn("kept", ~F.col("base_failed") & usual & worded)
