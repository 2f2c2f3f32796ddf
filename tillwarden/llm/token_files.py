"""Token ids in ORC files: run-length encoded integers, row indexes, Bloom filters on ids.

The files are in ascending order of ``doc_id``, so that the minimum and maximum
of each stripe and row group say which to read; the Bloom filters say it for
single ids. Stripes are read in parallel by Spark's own reader.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwarden.llm.common import pieces_of
from tillwarden.llm.library_ids import library_ids

CHUNK = 4 << 20
LAYOUT = "part int, place long, before long, doc_id long, n_tokens long, ids array<int>"
ORC = {
    "orc.stripe.size": str(16 << 20),
    "orc.row.index.stride": "1000",
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "compression": "lz4",
}


def _encode(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int
) -> Iterator[pa.RecordBatch]:
    encoder = library_ids(path)
    part, place, before = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        texts, keys = batch.column("text"), batch.column("doc_id")
        for a, b in pieces_of(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), CHUNK):
            ids, stops = encoder.encode_array(texts.slice(a, b - a))
            ids = np.insert(ids, stops, end_id)
            stops = np.concatenate([[0], stops + np.arange(1, b - a + 1)])
            lists = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(ids.view("<i4")))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(b - a, part, np.int32)),
                    pa.array(np.arange(place, place + b - a)),
                    pa.array(before + stops[:-1]),
                    keys.slice(a, b - a),
                    pa.array(np.diff(stops)),
                    lists,
                ],
                names=["part", "place", "before", "doc_id", "n_tokens", "ids"],
            )
            place += b - a
            before += int(stops[-1])


def write_tokens(docs: DataFrame, path: str, folder: str, end_id: int = 1) -> None:
    """Write the ids of every text, each followed by ``end_id``, to ``folder``.

    Documents are dealt into ranges of ``doc_id`` and sorted inside them. Rows of
    one id are told apart by a hash of their text and then by where they were
    read, so a heavy id is dealt to many ranges. The texts are shuffled once; ids
    are written where they are made. ``folder/ids`` has the ids, ``folder/parts``
    the number of ids before each range. A null or empty text is the end id
    alone; null ids come first; repeated rows are kept; no rows give empty files.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64("text").alias("tie"),
        F.monotonically_increasing_id().alias("seat"),
    )
    order = ["doc_id", "tie", "seat"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    sorted_rows.select("doc_id", "text").mapInArrow(
        partial(_encode, path=path, end_id=end_id), LAYOUT
    ).write.options(**ORC).orc(f"{folder}/ids")
    totals = _ids(spark, folder).groupBy("part").agg(F.sum("n_tokens").alias("held"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range: their number is the number of shuffle partitions.
    totals.select(
        "part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("ahead")
    ).write.orc(f"{folder}/parts")


def _ids(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(LAYOUT).orc(f"{folder}/ids")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids`` from the files.

    A filter on ``doc_id`` reaches the files' indexes and Bloom filters.
    """
    parts = spark.read.schema("part int, ahead long").orc(f"{folder}/parts")
    rows = _ids(spark, folder).join(F.broadcast(parts), "part")
    return rows.select("doc_id", (F.col("before") + F.col("ahead")).alias("start"), "n_tokens", "ids")


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        values = lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
        stops = lists.offsets.to_numpy()
        found = [zlib.crc32(values[a:b]) for a, b in zip(stops, stops[1:], strict=False)]
        columns = [batch.column(n) for n in ("doc_id", "start", "n_tokens")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(found, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def with_crc(tokens: DataFrame) -> DataFrame:
    """The unsigned crc32 of each document's ids as little-endian 32-bit integers."""
    return tokens.mapInArrow(_crc, "doc_id long, start long, n_tokens long, ids_crc32 long")
