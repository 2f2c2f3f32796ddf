"""Statistics of all transactions, kept as tables and brought up to date with new rows only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwarden.functions import money
from tillwarden.operators.ranking import ranks_of, value_counts
from tillwarden.sources.snapshots import Snapshots

TOTALS = (
    f"user_id string, rows long, amounts long, exact {money.EXACT}, other double, mean double, m2 double"
)
COUNTS = "amount double, rows_at long"


def user_totals(rows: DataFrame) -> DataFrame:
    """What the statistics of a user follow from and what can be added up, per user."""
    exact, other, amounts = money.parts("amount")
    return rows.groupBy("user_id").agg(
        F.count("*").alias("rows"),
        amounts.alias("amounts"),
        exact.alias("exact"),
        other.alias("other"),
        F.avg("amount").alias("mean"),
        (F.var_pop("amount") * amounts).alias("m2"),
    )


def merged_totals(totals: DataFrame) -> DataFrame:
    """Totals of disjoint sets of rows put together, at most a few rows per user.

    Squared deviations are merged about the common mean, not as differences of large sums.
    """
    parts = F.collect_list(F.struct("amounts", "mean", "m2"))
    sums = totals.groupBy("user_id").agg(
        F.sum("rows").alias("rows"),
        F.sum("amounts").alias("amounts"),
        F.sum("exact").cast(money.EXACT).alias("exact"),
        F.sum("other").alias("other"),
        F.filter(parts, lambda p: p["amounts"] > 0).alias("parts"),
    )
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda a, b: a + b)
    mean = F.try_divide(total(F.transform("parts", lambda p: p["mean"] * p["amounts"])), F.col("amounts"))
    sums = sums.withColumn("mean", mean)
    apart = F.transform(
        "parts", lambda p: p["m2"] + p["amounts"] * (p["mean"] - F.col("mean")) * (p["mean"] - F.col("mean"))
    )
    m2 = F.when(F.col("amounts") > 0, total(apart))
    return sums.select("user_id", "rows", "amounts", "exact", "other", "mean", m2.alias("m2"))


def merged_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy("amount").agg(F.sum("rows_at").alias("rows_at"))


def stats_of(totals: DataFrame) -> DataFrame:
    """The columns of :func:`tillwarden.operators.enrich.user_stats`, from totals."""
    deviation = F.sqrt(F.col("m2") / (F.col("amounts") - 1))
    return totals.select(
        "user_id",
        money.mean_of(F.col("exact"), F.col("other"), F.col("amounts")).alias("user_avg_amount"),
        F.col("rows").alias("user_transaction_count"),
        F.when(F.col("amounts") > 1, deviation).alias("user_amount_stddev"),
    )


@dataclass(frozen=True)
class Statistics:
    """Totals per user and row counts per amount of all rows seen so far, below ``folder``.

    Each table is a series of snapshots; the note of a snapshot says which batch
    of new rows it includes last, so a batch that comes again after a failure is
    not counted twice in either.
    """

    spark: SparkSession
    folder: str

    @property
    def users(self) -> Snapshots:
        return Snapshots(self.spark, f"{self.folder}/users")

    @property
    def amounts(self) -> Snapshots:
        return Snapshots(self.spark, f"{self.folder}/amounts")

    def update(self, rows: DataFrame) -> None:
        """Add what is new in a stream of transactions since the last call.

        A batch is reduced to one row per user and per amount before it meets the
        tables: rows seen before are not read again.
        """
        (
            rows.select("user_id", "amount")
            .writeStream.foreachBatch(self.add)
            .option("checkpointLocation", f"{self.folder}/_checkpoint")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )

    def add(self, rows: DataFrame, batch: int) -> None:
        """Add one batch of new rows."""
        for table, layout, reduced, merge in (
            (self.users, TOTALS, user_totals, merged_totals),
            (self.amounts, COUNTS, lambda r: value_counts(r, "amount"), merged_counts),
        ):
            if table.note().get("batch", -1) >= batch:
                continue
            new, before = reduced(rows), table.read(layout)
            table.publish(new if before is None else merge(before.unionByName(new)), note={"batch": batch})

    def user_stats(self) -> DataFrame | None:
        totals = self.users.read(TOTALS)
        return totals and stats_of(totals)

    def amount_ranks(self, alias: str = "amount_percentile") -> DataFrame | None:
        counts = self.amounts.read(COUNTS)
        return counts and ranks_of(counts, "amount", alias)
