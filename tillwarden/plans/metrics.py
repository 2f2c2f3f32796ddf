"""How the system itself is doing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwarden.functions.buckets import percent
from tillwarden.sources.snapshots import Snapshots


def throughput(transactions: DataFrame, every: str = "1 hour") -> DataFrame:
    """Transactions per time slice."""
    return (
        transactions.groupBy(F.window("event_time", every).alias("slice"))
        .agg(F.count("*").alias("transactions"))
        .select(F.col("slice.start").alias("window_start"), "transactions")
    )


def detection_rate(labelled: DataFrame, alerts: DataFrame) -> DataFrame:
    """Share of fraud transactions with an alert: 100 % when batch and stream agree.

    Both sides shrink to one row per transaction before the join, so repeated
    copies of an id cannot pile up in one task.
    """
    fraud = (
        labelled.where("is_fraud = 1").groupBy("transaction_id").agg(F.count("*").alias("copies"))
    )
    seen = alerts.groupBy("transaction_id").agg(F.lit(1).alias("seen"))
    caught = F.sum(F.when(F.col("seen").isNotNull(), F.col("copies")).otherwise(0))
    return (
        fraud.join(seen, "transaction_id", "left")
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("fraud_transactions"),
            F.coalesce(caught, F.lit(0)).alias("detected"),
        )
        .withColumn("detection_rate_percent", percent(F.col("detected"), F.col("fraud_transactions")))
    )


def response_time(alerts: DataFrame) -> DataFrame:
    """Seconds from event to alert per alert type: median, 95th and 99th percentile.

    ``alerts`` needs the ``timestamp`` text of point alerts; others have no
    single event time.
    """
    waited = F.col("alert_timestamp").cast("double") - F.try_to_timestamp("timestamp").cast(
        "double"
    )
    at = F.percentile_approx("seconds", [0.5, 0.95, 0.99])
    return (
        alerts.where(F.col("timestamp").isNotNull())
        .select("alert_type", waited.alias("seconds"))
        .groupBy("alert_type")
        .agg(at.alias("p"))
        .select(
            "alert_type",
            F.col("p")[0].alias("p50_seconds"),
            F.col("p")[1].alias("p95_seconds"),
            F.col("p")[2].alias("p99_seconds"),
        )
    )


# Of each quantile the rank is off by at most this share of the alerts (double-sided, for sketches of size 200).
RANK_ERROR = 0.0165
SKETCH_SIZE = 200
QUANTILES = {"p50_seconds": 0.5, "p95_seconds": 0.95, "p99_seconds": 0.99}
SKETCHES = "alert_type string, hour timestamp, alerts long, sketch binary"


def seconds_waited() -> Column:
    """From the event to its alert."""
    return F.col("alert_timestamp").cast("double") - F.try_to_timestamp("timestamp").cast("double")


def response_sketches(alerts: DataFrame) -> DataFrame:
    """A quantile sketch of the seconds waited per alert type and hour, to be kept and merged."""
    rows = alerts.where(F.col("timestamp").isNotNull()).select(
        "alert_type",
        F.date_trunc("hour", F.try_to_timestamp("timestamp")).alias("hour"),
        seconds_waited().alias("seconds"),
    )
    return rows.where(F.col("seconds").isNotNull()).groupBy("alert_type", "hour").agg(
        F.count("*").alias("alerts"), F.kll_sketch_agg_double("seconds", SKETCH_SIZE).alias("sketch")
    )


def merged_sketches(sketches: DataFrame, *keys: str) -> DataFrame:
    return sketches.groupBy(*keys).agg(
        F.sum("alerts").alias("alerts"), F.kll_merge_agg_double("sketch", SKETCH_SIZE).alias("sketch")
    )


def add_response_times(kept: Snapshots, alerts: DataFrame) -> None:
    """Merge the sketches of new alerts into the kept table: old alerts are not read again."""
    new, before = response_sketches(alerts), kept.read(SKETCHES)
    kept.publish(new if before is None else merged_sketches(before.unionByName(new), "alert_type", "hour"))


def response_quantiles(sketches: DataFrame, *keys: str) -> DataFrame:
    """Median, 95th and 99th percentile per alert type (and ``keys``), by merging sketches."""
    merged = merged_sketches(sketches, "alert_type", *keys)
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(c) for c, q in QUANTILES.items()]
    return merged.select("alert_type", *keys, "alerts", *found)


def row_counts(rows: DataFrame, is_test) -> DataFrame:
    """Rows in total and on either side of the train/test split, in one pass."""
    return rows.agg(
        F.count("*").alias("total_rows"),
        F.count_if(~is_test).alias("train_rows"),
        F.count_if(is_test).alias("test_rows"),
    )
