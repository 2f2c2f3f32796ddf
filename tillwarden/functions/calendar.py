"""Time-of-day and day-of-week features of an event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hour_of_day(event_time: Column) -> Column:
    return F.hour(event_time)


def is_weekend(event_time: Column) -> Column:
    """Monday is 0, so Saturday and Sunday are 5 and 6."""
    return F.weekday(event_time) >= 5


def with_event_time(transactions: DataFrame) -> DataFrame:
    """Parse the ISO text; text that is no time gives NULL instead of failing the job."""
    if "event_time" in transactions.columns:
        return transactions
    return transactions.withColumn("event_time", F.try_to_timestamp("timestamp"))


def with_calendar_features(transactions: DataFrame) -> DataFrame:
    at = F.col("event_time")
    return with_event_time(transactions).withColumns(
        {"hour_of_day": hour_of_day(at), "is_weekend": is_weekend(at)}
    )
