"""Exact percent rank over all rows without sorting them in one task."""

from __future__ import annotations

from math import ceil, sqrt

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwarden.operators.lookup import attach_per_key


def _quantiles(column: str, steps: int) -> str:
    """SQL for ``steps`` evenly spaced approximate quantiles, ascending."""
    places = ", ".join(f"{i / (steps + 1):.8f}D" for i in range(1, steps + 1))
    return f"percentile_approx({column}, array({places}), {max(10000, 4 * steps)})"


def _edges(counts: DataFrame, column: str, steps: int) -> DataFrame:
    """One row: the number of rows ``n``, and ``edges``, about ``steps`` quantiles of the distinct values.

    Each task's digest goes to one of as many groups as the root of the number of
    tasks; a group merges its digests to quantiles, and the quantiles of all groups
    are merged once more. So no task reads more digests than that root. Values lie
    in tasks by hash, so groups weigh the same. Edges only balance buckets.
    """
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = ceil(sqrt(partitions))
    grouped = (
        counts.withColumn("merged_in", F.spark_partition_id() % groups)
        .groupBy("merged_in")
        .agg(F.sum("rows_at").alias("held"), F.expr(_quantiles(column, steps)).alias("edges"))
    )
    each = grouped.select("held", F.posexplode_outer("edges").alias("place", "edge"))
    first = F.coalesce(F.col("place"), F.lit(0)) == 0
    return each.agg(
        F.sum(F.when(first, F.col("held"))).alias("n"), F.expr(_quantiles("edge", steps)).alias("edges")
    )


def _placed(counts: DataFrame, column: str, width: int) -> DataFrame:
    """Distinct values with their bucket: how many of ``width**2`` edges lie below.

    The edges come in blocks of ``width``: find the last block that starts below
    the value, then count inside it. NULL sorts first. Equal values always share
    a bucket, and the result depends on the value alone.
    """
    cut = (
        _edges(counts, column, width * width)
        .selectExpr(
            f"""struct(n, transform(sequence(0, {width - 1}),
                i -> slice(edges, i * {width} + 1, {width})) AS blocks) AS cut"""
        )
        .scalar()
    )
    return (
        counts.withColumn("cut", cut)
        .selectExpr(
            "*", f"size(filter(cut.blocks, edges -> edges[0] < {column})) AS blocks_below"
        )
        .selectExpr(
            column,
            "rows_at",
            "cut.n",
            f"""CASE WHEN {column} IS NULL THEN -1 WHEN blocks_below = 0 THEN 0
                ELSE (blocks_below - 1) * {width}
                  + size(filter(get(cut.blocks, blocks_below - 1), edge -> edge < {column}))
                END AS bucket""",
        )
    )


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    """How many rows have each value: ``column, rows_at``."""
    return rows.groupBy(column).agg(F.count("*").alias("rows_at"))


def distinct_value_ranks(rows: DataFrame, column: str, alias: str) -> DataFrame:
    """Percent rank of each distinct value: ``column, alias, rows_at``."""
    return ranks_of(value_counts(rows, column), column, alias)


def ranks_of(counts: DataFrame, column: str, alias: str) -> DataFrame:
    """Percent rank of each value of :func:`value_counts`.

    Ranks are running sums of row counts, so only distinct values are sorted:
    in buckets that hold about the same number of them, cut at approximate
    quantiles. What the buckets before contribute is a running sum over the
    bucket totals, at most ``width**2 + 2`` rows.
    """
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = min(64, ceil(sqrt(4 * partitions)))
    placed = _placed(counts, column, width)
    earlier = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        placed.groupBy("bucket")
        .agg(F.sum("rows_at").alias("in_bucket"))
        .select("bucket", F.coalesce(F.sum("in_bucket").over(earlier), F.lit(0)).alias("start"))
    )
    below = W.partitionBy("bucket").orderBy(column).rowsBetween(W.unboundedPreceding, -1)
    inside = placed.withColumn("inside", F.coalesce(F.sum("rows_at").over(below), F.lit(0)))
    rank = F.coalesce(
        F.try_divide((F.col("start") + F.col("inside")).cast("double"), F.col("n") - 1),
        F.lit(0.0),
    )
    # A left join: an inner one would push a bucket filter down to every row.
    return inside.join(F.broadcast(starts), "bucket", "left").select(
        column, rank.alias(alias), "rows_at"
    )


def with_percentile(
    rows: DataFrame,
    column: str = "amount",
    alias: str = "amount_percentile",
    spread: str = "transaction_id",
    ranks: DataFrame | None = None,
) -> DataFrame:
    """``(rank - 1) / (n - 1)`` ascending, nulls first, ties share; a lone row gets 0.

    ``ranks`` are those of :func:`distinct_value_ranks` if the caller has them.
    """
    if ranks is None:
        ranks = distinct_value_ranks(rows, column, alias)
    ranked = attach_per_key(rows, ranks, column, weight="rows_at", spread=spread)
    # Nulls rank first, so their share is 0; they match nothing in the join.
    return ranked.withColumn(alias, F.coalesce(alias, F.lit(0.0))).drop("rows_at")
