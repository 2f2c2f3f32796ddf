"""The detection job: messages in, alerts out, unusable messages set aside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwarden.config import RuleConfig
from tillwarden.operators.alerts import all_alerts, burst_alerts, in_table_layout
from tillwarden.sources import warehouse
from tillwarden.sources.kafka import ALERTS, send_stream
from tillwarden.sources.messages import decode_rule_fields, split_valid

LATENESS = "10 minutes"


def usable_transactions(
    messages: DataFrame, time_column: str = "event_time"
) -> tuple[DataFrame, DataFrame]:
    """Decoded rows and rejects. Arrival time is the message's own ``timestamp``."""
    if time_column == "event_time":
        return split_valid(decode_rule_fields(messages))
    arrived = messages.withColumnRenamed("timestamp", time_column)
    return split_valid(decode_rule_fields(arrived, keep=[time_column]))


def detect(
    transactions: DataFrame,
    cfg: RuleConfig = RuleConfig(),
    lateness: str = LATENESS,
    time_column: str = "event_time",
) -> DataFrame:
    """All alerts of a stream of transactions.

    Point alerts come at once. A burst is reported when the watermark passes the
    end of its window; rows later than ``lateness`` no longer count for it. What is
    open when the stream stops is reported by :func:`drain`.
    """
    return all_alerts(transactions.withWatermark(time_column, lateness), cfg, time_column)


def start_to_table(
    messages: DataFrame,
    database: str,
    checkpoint: str,
    cfg: RuleConfig = RuleConfig(),
    lateness: str = LATENESS,
    once: bool = False,
    time_column: str = "event_time",
) -> StreamingQuery:
    """Append the alerts to the alert table."""
    good, _ = usable_transactions(messages, time_column)
    alerts = detect(good, cfg, lateness, time_column)
    return warehouse.append_stream(alerts, database, warehouse.ALERTS, checkpoint, once)


def open_bursts(spark: SparkSession, checkpoint: str, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    """Bursts so far in the windows a stopped detection stream has not closed, from its checkpoint.

    The state of the window aggregate is read as a table: one row per user and open
    window, with the count and the latest row.
    """
    state = spark.read.format("statestore").load(checkpoint)
    count, last = state.schema["value"].dataType.names[:2]
    windows = state.select(
        F.col("key.window.start").alias("start"),
        F.col("key.user_id").alias("user_id"),
        F.col("value")[count].alias("transaction_count"),
        F.col("value")[last].alias("last_transaction_id"),
    )
    return in_table_layout(burst_alerts(windows, cfg))


def drain(
    spark: SparkSession, database: str, checkpoint: str, cfg: RuleConfig = RuleConfig()
) -> None:
    """Make the bursts of open windows readable once the detection stream into the table has stopped.

    They are a version of their own beside the alert table, replaced by each call:
    the windows stay open, and should the stream go on, their final alerts, which
    have the same ids, take the place of these (:func:`warehouse.alerts`). With no
    window ever opened there is nothing to do.
    """
    if spark.read.format("state-metadata").load(checkpoint).isEmpty():
        return
    warehouse.open_alerts(spark, database).publish(open_bursts(spark, checkpoint, cfg))


def start_to_kafka(
    messages: DataFrame,
    servers: str,
    checkpoint: str,
    cfg: RuleConfig = RuleConfig(),
    lateness: str = LATENESS,
    time_column: str = "event_time",
) -> StreamingQuery:
    """Publish the alerts as JSON."""
    good, _ = usable_transactions(messages, time_column)
    alerts = detect(good, cfg, lateness, time_column).drop(warehouse.PARTITION)
    return send_stream(alerts, servers, ALERTS, checkpoint)


def start_rejects(
    messages: DataFrame,
    folder: str,
    checkpoint: str,
    once: bool = False,
    time_column: str = "event_time",
) -> StreamingQuery:
    """Keep unusable messages with the reason, next to the running detection."""
    _, rejects = usable_transactions(messages, time_column)
    writer = rejects.writeStream.format("json").option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(folder)
