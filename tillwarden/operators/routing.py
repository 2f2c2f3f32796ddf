"""What happens to an alert: notifications, immediate response, audit trail."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwarden.config import SEVERITY_CHANNELS
from tillwarden.operators.lookup import fixed_table

AUDIT_COLUMNS = [
    "alert_id",
    "alert_type",
    "severity",
    "user_id",
    "transaction_id",
    "amount",
    "location",
    "merchant_id",
]


def with_defaults(alerts: DataFrame) -> DataFrame:
    """Fill what a sender may leave out, so that no alert stops the consumer."""
    fill = {"alert_type": "UNKNOWN", "severity": "LOW", "user_id": "UNKNOWN", "amount": 0.0}
    return alerts.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in fill.items()})


def channel_matrix(spark: SparkSession) -> DataFrame:
    """The fixed severity table, one row per switched-on channel (six rows)."""
    rows = [(s, c) for s, channels in SEVERITY_CHANNELS.items() for c in channels]
    return fixed_table(spark, ["severity", "channel"], rows)


def notifications(alerts: DataFrame, matrix: DataFrame | None = None) -> DataFrame:
    """One row per alert and channel to notify.

    Severities without a channel, known or not, produce none: they are only
    logged. A matrix given by the caller (``severity, channel``) is joined
    without a hint.
    """
    if matrix is None:
        matrix = F.broadcast(channel_matrix(alerts.sparkSession))
    return (
        with_defaults(alerts)
        .join(matrix, "severity")
        .select("alert_id", "alert_type", "severity", "user_id", "amount", "channel")
    )


def immediate_responses(alerts: DataFrame) -> DataFrame:
    """Critical alerts, each with the action it calls for."""
    critical = with_defaults(alerts).where(F.col("severity") == "CRITICAL")
    return critical.select(*AUDIT_COLUMNS, F.lit("IMMEDIATE_RESPONSE").alias("action"))


def audit_log(alerts: DataFrame) -> DataFrame:
    """Every alert as received, with the time it was logged."""
    return alerts.select(F.current_timestamp().alias("timestamp"), *AUDIT_COLUMNS)
