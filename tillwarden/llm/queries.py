"""The operators as queries over the test tables, and SQL for those SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwarden.llm import (
    byte_bpe,
    exact_dedup,
    fill_middle,
    jaccard,
    line_dedup,
    merkle,
    packing,
    pii,
    quality,
    quality_rules,
    token_count,
    token_files,
    topk,
)
from tillwarden.llm.common import ready
from tillwarden.operators.lookup import stage
from tillwarden.session import apply_settings, shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register a function under its own name."""

    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(ready(apply_settings(spark)), sf_dir)

    QUERIES[run.__name__] = prepared
    return run


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_token_counts(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_count.token_counts(_documents(spark, sf_dir), path, limit=512)


@query
def op2_topk(spark, sf_dir):
    folder = shared_folder(spark, "topk")
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    vectors = stage(topk.integer_vectors(embeddings), f"{folder}/vectors")
    return topk.top_products(vectors, vectors.where("vec_id % 50 = 0"), folder, k=5)


@query
def op3_byte_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    decoded = byte_bpe.decode(byte_bpe.encode(_documents(spark, sf_dir), path), path)
    return decoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_quality(spark, sf_dir):
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality.scored(docs, quality.fit(docs, labels, shared_folder(spark, "classifier")))


@query
def op5_token_files(spark, sf_dir):
    folder = shared_folder(spark, "tokens")
    path = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_tokens(_documents(spark, sf_dir), path, folder, end_id=1)
    return token_files.with_crc(token_files.read_tokens(spark, folder))


@query
def op6_personal_data(spark, sf_dir):
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    found = pii.personal_data(docs, pii.fit(docs, shared_folder(spark, "pii")))
    counts = ["n_email", "n_ip", "n_card", "n_phone"]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


@query
def op7_jaccard_join(spark, sf_dir):
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    joined = jaccard.jaccard_join(docs, shared_folder(spark, "jaccard"))
    return joined.select("doc_id", "n_shingles", "component_id")


@query
def op8_packing(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = packing.pack(_documents(spark, sf_dir), path, end_id=0)
    length = F.floor(F.octet_length("ids") / 4).cast("long")
    return pieces.select(
        "doc_id",
        "start",
        length.alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query
def op9_quality_rules(spark, sf_dir):
    folder = shared_folder(spark, "quality")
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    rows, q = quality_rules.measured(docs)
    rows = stage(rows.drop("text"), f"{folder}/measured")
    return quality_rules.judge(rows, q, f"{folder}/references").drop("lang")


@query
def op10_line_dedup(spark, sf_dir):
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    kept = line_dedup.dedup_lines(docs, folder=shared_folder(spark, "lines"))
    return kept.select("doc_id", "n_lines", "n_removed", "kept_text")


@query
def op11_fill_in_middle(spark, sf_dir):
    made = fill_middle.fill_in_middle(_documents(spark, sf_dir))
    back = fill_middle.restored(F.col("form"), F.col("output"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


@query
def op12_merkle_manifest(spark, sf_dir):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    leaves = merkle.document_leaves(_documents(spark, sf_dir), tampered)
    rows = merkle.manifest(leaves, shared_folder(spark, "manifest"))
    root = merkle.folded(F.coalesce("claimed", "leaf"), F.col("siblings"))
    digests = {
        "leaf": merkle.hexed(F.col("leaf")),
        "subroot": merkle.hexed(F.col("subroot")),
        "root": merkle.hexed(F.col("root")),
        "proof_sha256": F.sha2(merkle.proof_text(F.col("siblings")), 256),
        "folded_root": merkle.hexed(root),
    }
    rows = rows.select("doc_id", *[c.alias(n) for n, c in digests.items()])
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op13_exact_dedup(spark, sf_dir):
    name, folder = f"digests_{uuid.uuid4().hex[:12]}", shared_folder(spark, "digests")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = exact_dedup.DigestIndex(spark, name, folder, buckets).open()
    found = exact_dedup.dedup(_documents(spark, sf_dir), index)
    digest = F.lower(F.hex("digest")).alias("text_sha256")
    return found.select("doc_id", "keep_id", "group_size", "kept", digest)


ORACLE: dict[str, str] = {
    "op12_merkle_manifest": merkle.ORACLE,
    "op13_exact_dedup": exact_dedup.ORACLE,
    "op2_topk": topk.ORACLE,
    "op10_line_dedup": line_dedup.ORACLE,
}
