"""The alert consumer: audit every alert, route notifications, pick out critical ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwarden import schemas
from tillwarden.operators import routing
from tillwarden.sources import warehouse

OUTPUTS = {
    "audit": routing.audit_log,
    "notifications": routing.notifications,
    "responses": routing.immediate_responses,
}
# What acts on an alert must act once, however often the alert comes.
ONCE_PER_ALERT = {"notifications", "responses"}
REPLAYS = "7 days"


def alert_stream(spark: SparkSession, database: str) -> DataFrame:
    """The alert table as a stream, with the alerts of open windows each time they are drained."""
    layout = schemas.ALERT_TABLE
    final = spark.readStream.table(f"{database}.{warehouse.ALERTS}")
    drained = warehouse.open_alerts(spark, database)
    if drained.current() is None:
        return final
    still_open = spark.readStream.schema(layout).parquet(f"{drained.root}/v-*")
    return final.select(*layout.names).unionByName(still_open.select(*layout.names))


def first_of_each(alerts: DataFrame, replays: str = REPLAYS) -> DataFrame:
    """Each alert once: those whose id came within ``replays`` before are left out.

    A topic delivers at least once, and an alert of an open window comes again when
    the window closes. Ids are kept as long as the newest ``alert_timestamp`` is at most
    ``replays`` ahead; an alert older than that is taken for a replay. One without an id
    is known by all its fields, one without a time gets the current one.
    """
    fields = F.to_json(F.struct(*alerts.columns), {"ignoreNullFields": "false"})
    known = alerts.withColumns(
        {
            "_id": F.coalesce("alert_id", F.sha2(fields, 256)),
            "_at": F.coalesce("alert_timestamp", F.current_timestamp()),
        }
    )
    if not alerts.isStreaming:
        return known.dropDuplicates(["_id"]).drop("_id", "_at")
    return known.withWatermark("_at", replays).dropDuplicatesWithinWatermark(["_id"]).drop("_id", "_at")


def start_monitor(
    alerts: DataFrame, folder: str, checkpoint: str, once: bool = False, replays: str = REPLAYS
) -> dict[str, StreamingQuery]:
    """One query per output, each with its own checkpoint and written exactly once.

    Separate queries let the audit trail go on when a notification sink is down.
    The audit has every alert as received; an alert that comes again is notified
    and answered once.
    """
    queries = {}
    for name, output in OUTPUTS.items():
        writer = (
            output(first_of_each(alerts, replays) if name in ONCE_PER_ALERT else alerts)
            .writeStream.format("json")
            .outputMode("append")
            .option("checkpointLocation", f"{checkpoint}/{name}")
        )
        if once:
            writer = writer.trigger(availableNow=True)
        queries[name] = writer.start(f"{folder}/{name}")
    return queries
