"""Passages that repeat across documents: windows of consecutive lines, found by hash.

Every window of three lines is hashed. A window that occurs more than once stays
where it occurs first, in order of document and line; the lines that its later
occurrences cover are removed, each once however many windows cover it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwarden.llm.common import fresh
from tillwarden.operators.lookup import stage

WINDOW = 3
SALT = 1


def _lines(text: F.Column) -> F.Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def windows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``doc``, ``own`` (a hash of the text), ``n`` (its lines), ``line``, and the name of every window: ``hash`` and ``other``.

    Names have 128 bits, two hashes of the lines that share nothing, so that at any
    number of windows none repeats by chance. Windows without any character but white
    space are left out. Rows that agree in id and text are one document.
    """
    lines = docs.select(
        F.col("doc_id").cast("long").alias("doc"),
        F.xxhash64("text").alias("own"),
        _lines(F.col("text")).alias("lines"),
    )
    # A line is hashed once by each; a window is the hash of its lines' hashes.
    hashed = lines.select(
        "doc",
        "own",
        F.transform("lines", lambda x: F.xxhash64(x)).alias("hashes"),
        F.transform("lines", lambda x: F.xxhash64(F.lit(SALT), F.reverse(x), F.length(x))).alias("others"),
        F.transform("lines", lambda x: F.trim(F.translate(x, "\t\r\x0b\x0c", "    ")) == "").alias("blank"),
    )
    named = (("hashes", "hash"), ("others", "other"))
    made = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("hashes") - size, F.lit(0))),
        lambda i: F.when(
            ~_all([F.get("blank", i + k) for k in range(size)]),
            F.struct(*[F.xxhash64(*[F.get(source, i + k) for k in range(size)]).alias(name) for source, name in named]),
        ),
    )
    # A text of fewer lines is one window, which no longer one equals.
    few = F.struct(*[F.xxhash64(F.size("hashes"), F.col(source)).alias(name) for source, name in named])
    some = F.exists("blank", lambda b: ~b)
    made = F.when(F.size("hashes") >= size, made).when(some, F.array(few))
    found = hashed.select("doc", "own", F.size("hashes").alias("n"), F.posexplode(made).alias("line", "name"))
    return found.where(F.col("name").isNotNull()).select("doc", "own", "n", "line", "name.hash", "name.other")


def _all(conditions: list[F.Column]) -> F.Column:
    found = conditions[0]
    for c in conditions[1:]:
        found = found & c
    return found


def repeated_windows(found: DataFrame) -> DataFrame:
    """Later occurrences of windows: ``doc``, ``own``, ``n`` and ``line``.

    What occurs once is told before the join; a hash that holds a large share of
    all windows is merged before the shuffle, and Spark splits it in the join.
    """
    place = F.struct(F.col("doc"), F.col("own"), F.col("line"))
    first = (
        found.groupBy("hash", "other")
        .agg(F.min(place).alias("first"), F.count("*").alias("times"))
        .where(F.col("times") > 1)
        .drop("times")
    )
    later = found.join(first, ["hash", "other"]).where(~place.eqNullSafe(F.col("first")))
    return later.select("doc", "own", "n", "line")


def dedup_lines(docs: DataFrame, size: int = WINDOW, folder: str | None = None) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_removed`` and the ``kept_text``; a row for every row.

    ``kept_text`` is the text without the removed lines; null stays null, and a
    text that loses no line is as it was. A text of fewer than ``size`` lines is one
    window: copies of the first lose all of it. Rows alike in ``doc_id`` and text get one result;
    documents are ordered by ``doc_id`` (null first), then by a hash of the text.
    Columns that ``docs`` has under the new names are replaced. The texts are
    shuffled once, by id and hash. With a ``folder`` the removed lines are written
    there first, so that a lost executor does not find them again.
    """
    later = repeated_windows(windows(docs, size))
    covered = F.flatten(
        F.transform(F.collect_set("line"), lambda i: F.sequence(i, F.least(i + size, F.col("n")) - 1))
    )
    # At most as many places as the document has lines, in order.
    removed = later.groupBy("doc", "own", "n").agg(F.sort_array(F.array_distinct(covered)).alias("gone"))
    # Whether each line up to the last removed one goes: looked up by its number.
    before = lambda j: F.coalesce(F.get("gone", j - 1), F.lit(-1))
    marks = F.transform(
        F.sequence(F.lit(0), F.size("gone") - 1),
        lambda j: F.concat(F.array_repeat(F.lit(False), F.get("gone", j) - before(j) - 1), F.array(F.lit(True))),
    )
    removed = removed.select("doc", "own", F.size("gone").alias("many"), F.flatten(marks).alias("gone"))
    removed = stage(removed, folder)
    names = {n: fresh(n, docs) for n in ("doc", "own", "many", "gone")}
    removed = removed.select(*[F.col(n).alias(other) for n, other in names.items()])
    doc, own, many, gone = names.values()
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(doc)) & (
        F.xxhash64(docs["text"]) == F.col(own)
    )
    # The list grows with the documents, so the plan is the same at every size.
    rows = docs.join(removed.hint("merge"), same, "left")
    lines = _lines(F.col("text"))
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.coalesce(F.get(gone, i), F.lit(False))), "\n")
    results = {
        "n_lines": F.size(lines).cast("long"),
        "n_removed": F.coalesce(many, F.lit(0)).cast("long"),
        "kept_text": F.when(F.col(gone).isNull(), F.col("text")).otherwise(kept),
    }
    # Columns are made from docs' own before any of them is replaced.
    others = [F.col(c) for c in docs.columns if c.lower() not in results]
    return rows.select(*others, *[c.alias(n) for n, c in results.items()])


ORACLE = """
WITH lined AS (
    SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), windowed AS (
    SELECT doc_id, i - 1 AS line, lines[i:i + 2] AS passage
    FROM (SELECT doc_id, lines, unnest(range(1, greatest(len(lines) - 1, 2))) AS i FROM lined)
), later AS (
    SELECT doc_id, line FROM (
        SELECT doc_id, line, row_number() OVER (PARTITION BY passage ORDER BY doc_id, line) AS n
        FROM windowed WHERE regexp_matches(array_to_string(passage, ' '), '[^ \\t\\r\\n\\v\\f]')
    ) WHERE n > 1
), gone AS (
    SELECT DISTINCT doc_id, line + k AS line
    FROM later JOIN lined USING (doc_id), (VALUES (0), (1), (2)) AS offsets(k)
    WHERE line + k < len(lines)
), counted AS (
    SELECT doc_id, list(line) AS places FROM gone GROUP BY doc_id
)
SELECT l.doc_id,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
    CASE WHEN places IS NULL THEN text ELSE coalesce(array_to_string(
        [lines[i] FOR i IN range(1, len(lines) + 1) IF NOT list_contains(places, i - 1)], chr(10)), '') END AS kept_text
FROM lined l LEFT JOIN counted c ON l.doc_id = c.doc_id
"""
