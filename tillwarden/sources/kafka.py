"""Thin Kafka ends. They need Spark's Kafka connector on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillwarden.sources.messages import to_messages

TRANSACTIONS = "transactions"
ALERTS = "fraud-alerts"


def _options(servers: str, topic: str, start: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}


def stream_messages(
    spark: SparkSession, servers: str, topic: str = TRANSACTIONS, start: str = "earliest"
) -> DataFrame:
    """``key, value, timestamp, …`` as they arrive; the checkpoint keeps the offsets."""
    return spark.readStream.format("kafka").options(**_options(servers, topic, start)).load()


def stored_messages(spark: SparkSession, servers: str, topic: str = TRANSACTIONS) -> DataFrame:
    """Everything the topic holds now, as a bounded read."""
    return spark.read.format("kafka").options(**_options(servers, topic, "earliest")).load()


def alert_messages(spark: SparkSession, servers: str) -> DataFrame:
    """Alerts from now on."""
    return stream_messages(spark, servers, ALERTS, start="latest")


def send_stream(
    rows: DataFrame, servers: str, topic: str, checkpoint: str, key: str | None = None
) -> StreamingQuery:
    """Publish a stream as JSON. Stable ids let readers drop a batch sent twice."""
    return (
        to_messages(rows, key)
        .writeStream.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic})
        .option("checkpointLocation", checkpoint)
        .start()
    )


def send_batch(rows: DataFrame, servers: str, topic: str, key: str | None = None) -> None:
    """Publish a bounded set of rows as JSON."""
    (
        to_messages(rows, key)
        .write.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic})
        .save()
    )
