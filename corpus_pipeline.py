"""From documents to packed sequences: rules, line dedup, near-duplicates, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor
kept; between stages the documents are written as Parquet and read again. All
stages but the last return the columns of the documents they got, whatever these
are called; ``n_chars``, where there is one, follows a changed text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwarden.llm import jaccard, line_dedup, packing, pii, quality_rules
from tillwarden.llm.common import ready
from tillwarden.operators.lookup import stage
from tillwarden.session import apply_settings, shared_folder

# Near-duplicates: five words, a similarity of 0.8 or more.
NEAR = jaccard.JoinRules(shingle=5, percent=80, longer=50)


def _folder(spark: SparkSession, name: str) -> str:
    return shared_folder(ready(apply_settings(spark)), name)


def _with_text(docs: DataFrame, text: Column) -> list[Column]:
    """The columns of documents held in a struct ``document``, with another text."""
    found = []
    for c in docs.columns:
        own = F.col("document")[c]
        if c == "text":
            own = text
        elif c == "n_chars":
            changed = ~text.eqNullSafe(F.col("document")["text"])
            own = F.when(changed, F.length(text)).otherwise(own).cast(docs.schema[c].dataType)
        found.append(own.alias(c))
    return found


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep, as they were.

    Measures are written with the documents: references are sums over all of
    them, and each document is then compared with its own.
    """
    folder = _folder(spark, "quality")
    language = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    apart = docs.select(F.struct(*docs.columns).alias("document"), "text", language.alias("language"))
    rows, q = quality_rules.measured(apart)
    rows = stage(rows.drop("text"), f"{folder}/measured")
    judged = quality_rules.judge(rows, q, f"{folder}/references", language="language")
    return judged.where("kept").select(*_with_text(docs, F.col("document")["text"]))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat earlier ones; those left without a word go."""
    apart = docs.select("doc_id", "text", F.struct(*docs.columns).alias("document"))
    found = line_dedup.dedup_lines(apart, folder=_folder(spark, "lines"))
    emptied = (F.col("n_removed") > 0) & ~F.col("kept_text").rlike(r"[^ \t\n\x0B\f\r]")
    kept = found.where(~F.coalesce(emptied, F.lit(False)))
    return kept.select(*_with_text(docs, F.col("kept_text")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id."""
    return jaccard.one_of_each(docs, _folder(spark, "near"), NEAR)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every span of personal data replaced by its kind."""
    field = pii.fit(docs, _folder(spark, "pii"))
    apart = docs.select("text", F.struct(*docs.columns).alias("document"))
    return pii.redact(apart, field).select(*_with_text(docs, F.col("text")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, with their ids, in sequences of at most 1024 tokens."""
    ready(apply_settings(spark))
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", pack),
]

# The field of the fourth stage is learned, and ids are a tokenizer's: no SQL has
# them. The tests run every stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        rows = stage(apply(spark, rows, sf_dir), _folder(spark, name))
    return STAGES[-1][1](spark, rows, sf_dir)
