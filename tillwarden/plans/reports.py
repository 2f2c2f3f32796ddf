"""The risk reports: small aggregates over processed transactions and alerts.

Every report needs only additive measures, so each task sums its own rows and
the shuffle carries one row per group and task, however large a group is.
Sorts and the unpartitioned ``lag`` run on finished groups.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillwarden.functions import money
from tillwarden.functions.buckets import activity_level, amount_band, percent


def _counts() -> list[Column]:
    """The measures every report shows: rows, fraud rows, and their ratio."""
    rows, fraud = F.count("*"), F.sum("is_fraud")
    return [
        rows.alias("total_transactions"),
        fraud.alias("fraud_transactions"),
        percent(fraud, rows).alias("fraud_rate_percent"),
    ]


def _mean(alias: str) -> Column:
    return money.rounded_mean("amount").alias(alias)


def _on(day: dt.date) -> Column:
    return F.col("processing_date") == F.lit(day).cast("date")


def _since(as_of: dt.date, days: int) -> Column:
    """Lower bound only, inclusive; a literal, so that partitions are pruned."""
    return F.col("processing_date") >= F.date_sub(F.lit(as_of).cast("date"), days)


def daily_fraud_stats(processed: DataFrame) -> DataFrame:
    fraud_amount = F.when(F.col("is_fraud") == 1, F.col("amount")).otherwise(0.0)
    return (
        processed.groupBy("processing_date")
        .agg(
            *_counts(),
            _mean("avg_transaction_amount"),
            money.total(fraud_amount).alias("total_fraud_amount"),
        )
        .orderBy(F.desc("processing_date"))
    )


def daily_fraud_rate(processed: DataFrame) -> DataFrame:
    return (
        processed.groupBy("processing_date")
        .agg(*_counts())
        .orderBy(F.desc("processing_date"))
    )


def top_fraud_users(processed: DataFrame, limit: int = 20) -> DataFrame:
    return (
        processed.groupBy("user_id")
        .agg(*_counts(), _mean("avg_amount"), money.total("amount").alias("total_amount"))
        .where(F.col("fraud_transactions") > 0)
        .orderBy(F.desc("fraud_transactions"), "user_id")
        .limit(limit)
    )


def merchant_analysis(processed: DataFrame, limit: int = 20, at_least: int = 10) -> DataFrame:
    return (
        processed.groupBy("merchant_id", "merchant_category")
        .agg(*_counts(), _mean("avg_amount"))
        .where(F.col("total_transactions") >= at_least)
        .orderBy(F.desc("fraud_rate_percent"), "merchant_id", "merchant_category")
        .limit(limit)
    )


def location_analysis(processed: DataFrame, at_least: int = 5) -> DataFrame:
    return (
        processed.groupBy("location")
        .agg(*_counts(), _mean("avg_amount"))
        .where(F.col("total_transactions") >= at_least)
        .orderBy(F.desc("fraud_rate_percent"), "location")
    )


def time_patterns(processed: DataFrame) -> DataFrame:
    keys = ["hour_of_day", "is_weekend"]
    return processed.groupBy(*keys).agg(*_counts()).orderBy(*keys)


def channel_card_analysis(processed: DataFrame) -> DataFrame:
    return (
        processed.groupBy("channel", "card_type")
        .agg(*_counts(), _mean("avg_amount"))
        .orderBy(F.desc("fraud_rate_percent"), "channel", "card_type")
    )


def amount_bands(processed: DataFrame) -> DataFrame:
    return (
        processed.groupBy(amount_band(F.col("amount")).alias("amount_range"))
        .agg(*_counts())
        .orderBy(F.desc("fraud_rate_percent"), "amount_range")
    )


def alerts_summary(alerts: DataFrame, as_of: dt.date, days: int = 7) -> DataFrame:
    """Exact distinct users; rapid alerts have no amount and stay out of the mean."""
    return (
        alerts.where(_since(as_of, days))
        .groupBy("alert_type", "severity")
        .agg(
            F.count("*").alias("alert_count"),
            F.count_distinct("user_id").alias("affected_users"),
            _mean("avg_amount"),
        )
        .orderBy(F.desc("alert_count"), "alert_type", "severity")
    )


def user_behavior(processed: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    return (
        processed.where(_since(as_of, days))
        .groupBy("user_id")
        .agg(
            F.count("*").alias("transaction_count"),
            F.count_distinct("merchant_id").alias("unique_merchants"),
            F.count_distinct("location").alias("unique_locations"),
            _mean("avg_amount"),
            F.round(F.stddev_samp("amount"), 2).alias("amount_stddev"),
            F.sum("is_fraud").alias("fraud_count"),
        )
    )


def user_activity(processed: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Per activity level: an unweighted mean of user means, but a weighted fraud rate.

    The level report uses neither the distinct counts nor the deviation of
    :func:`user_behavior`; Catalyst prunes them.
    """
    users = user_behavior(processed, as_of, days)
    fraud = F.sum("fraud_count")
    return users.groupBy(activity_level(F.col("transaction_count")).alias("activity_level")).agg(
        F.count("*").alias("user_count"),
        money.rounded_mean("avg_amount").alias("avg_transaction_amount"),
        fraud.alias("total_fraud_transactions"),
        percent(fraud, F.sum("transaction_count")).alias("fraud_rate_percent"),
    )


def fraud_trend(processed: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Daily rate against that of the previous date present; one row per date by then."""
    by_date = W.orderBy("processing_date")
    rate = F.col("fraud_rate_percent")
    return (
        processed.where(_since(as_of, days))
        .groupBy("processing_date")
        .agg(*_counts())
        .withColumn("prev_fraud_rate", F.lag(rate).over(by_date))
        .withColumn("fraud_rate_change", F.round(rate - F.col("prev_fraud_rate"), 2))
        .orderBy("processing_date")
    )


def merchant_fraud_on(
    processed: DataFrame, day: dt.date, limit: int = 10, at_least: int = 10
) -> DataFrame:
    return (
        processed.where(_on(day))
        .groupBy("merchant_id")
        .agg(*_counts())
        .where(F.col("total_transactions") >= at_least)
        .orderBy(F.desc("fraud_rate_percent"), "merchant_id")
        .limit(limit)
    )


def hourly_pattern_on(processed: DataFrame, day: dt.date) -> DataFrame:
    return (
        processed.where(_on(day))
        .groupBy("hour_of_day")
        .agg(*_counts())
        .orderBy("hour_of_day")
    )


def batch_reports(processed: DataFrame, day: dt.date) -> dict[str, DataFrame]:
    """The three reports of a batch run, lazy."""
    return {
        "daily_summary": daily_fraud_stats(processed),
        "merchant_fraud": merchant_fraud_on(processed, day),
        "hourly_pattern": hourly_pattern_on(processed, day),
    }
