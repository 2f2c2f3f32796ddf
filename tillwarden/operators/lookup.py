"""Joins to fixed small tables, and to per-key values when a key may be very heavy."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEAVY_KEYS = 256


def attach_per_key(
    rows: DataFrame,
    per_key: DataFrame,
    key: str,
    weight: str,
    spread: str,
    heavy_keys: int = HEAVY_KEYS,
) -> DataFrame:
    """Left-join ``per_key`` (one row per ``key``, ``weight`` rows each) to ``rows``.

    The ``heavy_keys`` heaviest keys come from a broadcast whose size that limit
    bounds, whatever the data. Their rows, and rows without a key, already have
    their answer, so the shuffle join routes them by ``spread`` and map task
    instead of the key: evenly, even if they are copies of one row, and the same
    way when a lost task runs again. Any other key holds less than one row in
    ``heavy_keys``. The top-k and the join read the same aggregate, so its
    shuffle is done once and reused.
    """
    values = [c for c in per_key.columns if c != key]
    heavy = per_key.orderBy(F.desc(weight), key).limit(heavy_keys)
    heavy = heavy.select(key, *[F.col(v).alias(f"_heavy_{v}") for v in values])
    light = per_key.select(
        F.xxhash64(key).alias("_route"), key, *[F.col(v).alias(f"_light_{v}") for v in values]
    )

    answered = F.col(key).isNull() | F.col(f"_heavy_{weight}").isNotNull()
    anywhere = F.xxhash64(spread, F.spark_partition_id())
    tagged = rows.join(F.broadcast(heavy), key, "left").withColumn(
        "_route", F.when(answered, anywhere).otherwise(F.xxhash64(key))
    )
    # The route goes first: sorting compares it as a number, and it rarely ties.
    joined = tagged.join(light, ["_route", key], "left")
    found = [F.coalesce(f"_heavy_{v}", f"_light_{v}").alias(v) for v in values]
    return joined.select(*rows.columns, *found)


def stage(rows: DataFrame, folder: str | None) -> DataFrame:
    """Write ``rows`` to a new folder and read them back; without a folder, as they are.

    A written table has a known size, so a join to it is planned as a broadcast
    while it is small and moves the other side only when it must. It is also
    computed once, however many steps read it and whichever executors are lost.
    """
    if folder is None:
        return rows
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def fixed_table(
    spark: SparkSession, columns: Sequence[str], rows: Iterable[Sequence[str]]
) -> DataFrame:
    """A handful of constant text rows as a local relation, safe to broadcast."""
    values = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS fixed({', '.join(columns)})")
