"""What the operators share: small Arrow batches, memos of bounded size, column names, joins by size."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwarden.operators.lookup import stage

# A batch holds rows or bytes up to these, whichever comes first, so that a run
# of very long texts does not fill a worker.
BATCH_ROWS = 2000
BATCH_BYTES = 4 << 20
# Up to so many rows of one or two numbers a list may be sent to every executor.
BROADCAST_ROWS = 500_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ready(spark: SparkSession) -> SparkSession:
    """Keep the batches that Spark hands to Python small, and let workers find this package.

    The second part serves a session whose driver found the package by its own
    ``sys.path``. On a cluster the package is installed or sent with the job.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root, environment = str(Path(__file__).parents[2]), spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])
    return spark


def staged(rows: DataFrame, folder: str) -> DataFrame:
    """``rows`` written to ``folder`` and read again; the shuffle files of the write go when it ends.

    Otherwise they stay until the driver happens to collect its garbage. The
    session's own setting is put back.
    """
    conf = rows.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        return stage(rows, folder)
    finally:
        conf.set(CLEANUP, before)


def fresh(base: str, *frames: DataFrame) -> str:
    """A column name none of the frames has, whatever the case."""
    taken = {c.lower() for f in frames for c in f.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def pieces_of(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Cut rows of the given sizes into runs of at most ``most``, or of one larger row."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


class Memo(dict):
    """Remembers a function of a text; forgets everything once ``limit`` texts are kept.

    Long texts are computed each time: they rarely come again, and would make the
    size of the memo depend on them.
    """

    def __init__(self, compute: Callable[[str], Any], limit: int, longest: int = 48):
        super().__init__()
        self.compute, self.limit, self.longest = compute, limit, longest

    def __missing__(self, key: str):
        value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


def hint_if_small(rows: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a written table of narrow rows for broadcast if it has at most ``most`` rows.

    Beyond that it is returned as it is, and Spark plans a shuffle join.
    """
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows
