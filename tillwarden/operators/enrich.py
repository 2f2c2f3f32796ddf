"""Per-user statistics, dimension lookups, the fraud label and the processed layout."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwarden import schemas
from tillwarden.config import DEFAULT_CATEGORY, MERCHANT_CATEGORIES, RuleConfig
from tillwarden.functions import money, rules
from tillwarden.functions.calendar import with_event_time
from tillwarden.operators.lookup import attach_per_key, fixed_table, stage
from tillwarden.operators.ranking import distinct_value_ranks, with_percentile


def user_stats(transactions: DataFrame) -> DataFrame:
    """Mean, count and sample standard deviation of the amount per user."""
    return transactions.groupBy("user_id").agg(
        money.mean("amount").alias("user_avg_amount"),
        F.count("*").alias("user_transaction_count"),
        F.stddev_samp("amount").alias("user_amount_stddev"),
    )


def with_user_stats(transactions: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Each row with its user's statistics; a row without a user has none."""
    if stats is None:
        stats = user_stats(transactions)
    return attach_per_key(
        transactions,
        stats,
        "user_id",
        weight="user_transaction_count",
        spread="transaction_id",
    )


def merchant_dimension(spark: SparkSession) -> DataFrame:
    return fixed_table(spark, ["merchant_id", "merchant_category"], MERCHANT_CATEGORIES.items())


def with_merchant_category(
    transactions: DataFrame, dimension: DataFrame | None = None
) -> DataFrame:
    """Look up the category; unknown merchants get the default.

    The built-in dimension has 14 rows and is broadcast. One given by the caller
    (``merchant_id, merchant_category``) carries no hint: Spark decides by size.
    """
    if dimension is None:
        dimension = F.broadcast(merchant_dimension(transactions.sparkSession))
    rows = transactions.drop("merchant_category").join(dimension, "merchant_id", "left")
    return rows.withColumn(
        "merchant_category", F.coalesce("merchant_category", F.lit(DEFAULT_CATEGORY))
    )


def with_label(transactions: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    return transactions.withColumn("is_fraud", rules.fraud_label(cfg))


def with_processing_date(
    transactions: DataFrame, processing_date: dt.date | None = None
) -> DataFrame:
    """Stamp the run date if one is given, else the date the transaction happened."""
    if processing_date is not None:
        return transactions.withColumn("processing_date", F.lit(processing_date).cast("date"))
    if "processing_date" in transactions.columns:
        return transactions
    return with_event_time(transactions).withColumn("processing_date", F.to_date("event_time"))


def enrich(
    transactions: DataFrame,
    processing_date: dt.date | None = None,
    cfg: RuleConfig = RuleConfig(),
    folder: str | None = None,
    stats: DataFrame | None = None,
    ranks: DataFrame | None = None,
) -> DataFrame:
    """Transactions in, the 18 columns of the processed table out.

    Lazy without a ``folder``. With one, user statistics and amount ranks are
    staged below it first; each then reads one or two columns of the input. Who
    keeps statistics gives them as ``stats`` (:func:`user_stats`) and ``ranks``
    (:func:`distinct_value_ranks`); the input is then read once.
    """
    if stats is None:
        stats = user_stats(transactions)
    stats = stage(stats.drop("user_amount_stddev"), folder and f"{folder}/users")
    if ranks is None:
        ranks = distinct_value_ranks(transactions, "amount", "amount_percentile")
    ranks = stage(ranks, folder and f"{folder}/ranks")
    rows = with_percentile(with_user_stats(transactions, stats), ranks=ranks)
    rows = rows.withColumns(
        {
            "is_unusual_amount": F.col("amount") > F.col("user_avg_amount") * cfg.unusual_factor,
            "is_unusual_location": rules.is_unknown_location(cfg),
            "is_fraud": rules.fraud_label(cfg),
        }
    )
    return with_processing_date(rows, processing_date).select(*schemas.PROCESSED.names)
