"""Exact dedup against a persistent index of digests, bucketed and sorted by digest.

A batch of documents is reduced to one row per digest, sort-merge joined with
the index, and what the index lacks is appended to it in the same buckets. The
index is never shuffled, whatever its size.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwarden.llm.common import staged
from tillwarden.operators.lookup import attach_per_key

# A lone space would be replaced by itself, so only other runs are looked for.
BLANKS = "[\t-\r][ \t-\r]*| [ \t-\r]+"
LAYOUT = "digest BINARY, keep_id BIGINT, batch BIGINT"
ROWS = "doc_id long, digest binary, seat long"
NOTES = "digest binary, keep_id long, batch long, own_seat long, copies long"


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " ")


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the ``digest`` of the normalised text: all that later steps read."""
    digest = F.unhex(F.sha2(normalised(F.col("text")).cast("binary"), 256))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest.alias("digest"))


@dataclass(frozen=True)
class DigestIndex:
    """The table of all digests kept so far, in ``folder``, known to the catalog as ``name``.

    ``digest``, ``keep_id`` (the document that stays) and ``batch`` (the number of
    the batch that brought it). ``buckets`` are fixed when the table is made: a bucket
    is one task of each join, so as many as the cluster's shuffles have suit it. What each batch brought is noted beside it,
    some 50 bytes a document.
    """

    spark: SparkSession
    name: str
    folder: str
    buckets: int

    def open(self) -> DigestIndex:
        """Create the table, or attach the files an earlier session left in ``folder``."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({LAYOUT}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.folder.rstrip('/')}/index'"
        )
        return self

    def table(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def _batch(self, batch: int) -> str:
        return f"{self.folder.rstrip('/')}/batches/{batch}"

    def add(self, rows: DataFrame, batch: int) -> None:
        """Append the digests of ``doc_id, digest`` rows that the index lacks; note what became of the others.

        Rows are counted per digest before the shuffle, so a text with any number
        of copies is no task's burden. A batch that was cut short is added again
        with the same rows: what it had appended is found by the anti-join, the
        rest follows, and its notes are replaced.
        """
        folder = self._batch(batch)
        numbered = rows.select("doc_id", "digest", F.monotonically_increasing_id().alias("seat"))
        rows = _replaced(numbered, f"{folder}/rows")
        groups = rows.groupBy("digest").agg(
            F.min("doc_id").alias("own_id"),
            F.coalesce(F.min_by("seat", "doc_id"), F.min("seat")).alias("own_seat"),
            F.count("*").alias("copies"),
        )
        # Dealt to tasks as the table deals digests to buckets: the index is not shuffled,
        # and a batch adds one sorted file to a bucket.
        dealt = _replaced(groups, f"{folder}/groups").repartition(self.buckets, "digest")
        fresh = dealt.join(self.table().hint("merge"), "digest", "left_anti")
        fresh = fresh.select("digest", F.col("own_id").alias("keep_id"), F.lit(batch).cast("long").alias("batch"))
        fresh.sortWithinPartitions("digest").write.insertInto(self.name)
        noted = dealt.join(self.table().hint("merge"), "digest")
        _replaced(noted.select("digest", "keep_id", "batch", "own_seat", "copies"), f"{folder}/notes")

    def members(self, batches: Sequence[int]) -> DataFrame:
        """``doc_id``, ``digest``, ``keep_id``, ``group_size`` and ``kept`` of every row of the batches.

        ``group_size`` counts the rows of these batches with the digest. Of equal
        texts the first batch keeps, within a batch the smallest id, before null
        ids; of several rows with that id, one. The heaviest digests are joined
        apart, so their rows are not brought to one task.
        """
        rows, notes = (
            reduce(DataFrame.unionByName, [self._read(f"{self._batch(b)}/{kind}", b) for b in batches])
            for kind in ("rows", "notes")
        )
        holds = F.col("batch") == F.col("source")
        per_digest = notes.groupBy("digest").agg(
            F.max("keep_id").alias("keep_id"),
            F.sum("copies").alias("group_size"),
            F.max(F.when(holds, F.col("batch"))).alias("holder"),
            F.max(F.when(holds, F.col("own_seat"))).alias("holder_seat"),
        )
        found = attach_per_key(rows, per_digest, "digest", weight="group_size", spread="seat")
        kept = (F.col("source") == F.col("holder")) & (F.col("seat") == F.col("holder_seat"))
        return found.select(
            "doc_id", "digest", "keep_id", "group_size", F.coalesce(kept, F.lit(False)).alias("kept")
        )

    def _read(self, folder: str, batch: int) -> DataFrame:
        layout = ROWS if folder.endswith("rows") else NOTES
        return self.spark.read.schema(layout).parquet(folder).withColumn("source", F.lit(batch).cast("long"))

    def compact(self) -> None:
        """One sorted file per bucket instead of one per batch: joins then need no sort.

        The merged files are written beside the table's before the table is
        pointed at them; readers of the old files are not disturbed.
        """
        target = f"{self.folder.rstrip('/')}/index-{_new()}"
        merged = f"{self.name}_{_new()}"
        described = self.spark.sql(f"DESCRIBE EXTENDED {self.name}").where("col_name = 'Location'")
        # Read as plain files: as a table, its rows would pass for dealt already.
        rows = self.spark.read.schema(LAYOUT).parquet(described.first()["data_type"])
        rows = rows.repartition(self.buckets, "digest").sortWithinPartitions("digest")
        writer = rows.write.format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
        writer.option("path", target).saveAsTable(merged)
        self.spark.sql(f"DROP TABLE {merged}")
        self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{target}'")
        self.spark.catalog.refreshTable(self.name)


def _new() -> str:
    return uuid.uuid4().hex[:12]


def _replaced(rows: DataFrame, folder: str) -> DataFrame:
    """``rows`` written in place of what an interrupted run may have left, and read again."""
    rows.write.mode("overwrite").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def dedup(docs: DataFrame, index: DigestIndex, batches: int = 2) -> DataFrame:
    """All of ``docs`` added to an empty ``index`` in ascending ranges of ``doc_id``, and judged.

    Every text is read once, to its digest. As ranges ascend, the row with the
    smallest id stays, whatever their borders; null ids come with the last range.
    Null and empty texts are equal; texts of any length are hashed whole; repeated
    rows form a group, of which one is kept; no rows give no rows. Other columns
    are not read.
    """
    rows = staged(digests(docs), f"{index.folder.rstrip('/')}/digests")
    shares = [k / batches for k in range(1, batches)] or [1.0]
    borders = rows.agg(F.percentile_approx("doc_id", shares)).first()[0] or []
    borders = sorted(set(borders)) if batches > 1 else []
    key = F.col("doc_id")
    place = sum((F.coalesce((key > b).cast("int"), F.lit(1)) for b in borders), F.lit(0))
    for k in range(len(borders) + 1):
        index.add(rows.where(place == k), k)
    return index.members(range(len(borders) + 1))


ORACLE = r"""
    WITH hashed AS (
        SELECT
            doc_id,
            sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
        FROM documents
    )
    SELECT
        doc_id,
        min(doc_id) OVER same AS keep_id,
        count(*) OVER same AS group_size,
        doc_id = min(doc_id) OVER same AS kept,
        text_sha256
    FROM hashed
    WINDOW same AS (PARTITION BY text_sha256)
"""
