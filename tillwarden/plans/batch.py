"""The batch run: land raw messages once, derive everything else from that table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwarden.config import RuleConfig
from tillwarden.operators.alerts import all_alerts
from tillwarden.operators.enrich import enrich
from tillwarden.plans.reports import batch_reports
from tillwarden.plans.statistics import Statistics
from tillwarden.plans.training import Trained, run_training
from tillwarden.session import shared_folder
from tillwarden.sources import warehouse
from tillwarden.sources.messages import CORRUPT, decode_transactions


def land(
    messages: DataFrame, database: str, checkpoint: str, rejects: str | None = None
) -> None:
    """Append the messages that are new since the last run to the raw table.

    ``messages`` is a stream with a ``value`` column. The checkpoint remembers
    how far the last run got, so nothing is landed twice. A message that does
    not fit the layout is landed as far as it can be read; ``rejects`` is a
    folder that also gets its text.
    """
    rows = decode_transactions(messages)
    warehouse.append_stream(rows, database, warehouse.RAW, checkpoint, once=True).awaitTermination()
    if rejects is not None:
        broken = rows.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))
        (
            broken.writeStream.format("text")
            .option("checkpointLocation", f"{checkpoint}-rejects")
            .trigger(availableNow=True)
            .start(rejects)
            .awaitTermination()
        )


def statistics(spark: SparkSession, database: str) -> Statistics:
    """The kept statistics of the raw table, beside it."""
    return Statistics(spark, f"{warehouse.location(spark, database, warehouse.RAW)}_statistics")


def process(
    spark: SparkSession,
    database: str,
    processing_date: dt.date | None = None,
    cfg: RuleConfig = RuleConfig(),
    alerts: bool = False,
) -> bool:
    """Rebuild the processed table from the raw one; False when that is empty.

    User means and percentiles look at the whole history, so the whole table is
    replaced: it has one row per raw row, whatever the run date. The statistics
    themselves are kept, and read only the raw rows that are new since the last
    run. Readers have the old table until the new one is complete. ``alerts`` also rebuilds the alert table, for a warehouse without
    a running alert stream: one table must not have both writers.
    """
    raw = warehouse.table(spark, database, warehouse.RAW)
    if raw.isEmpty():
        return False
    kept = statistics(spark, database)
    kept.update(spark.readStream.table(f"{database}.{warehouse.RAW}"))
    processed = enrich(
        raw,
        processing_date,
        cfg,
        shared_folder(spark, "enrich"),
        stats=kept.user_stats(),
        ranks=kept.amount_ranks(),
    )
    many_dates = processing_date is None
    warehouse.replace_partitions(processed, database, warehouse.PROCESSED, many_dates, whole=True)
    if alerts:
        warehouse.replace_partitions(all_alerts(raw, cfg), database, warehouse.ALERTS, whole=True)
    return True


def run_batch(
    messages: DataFrame,
    database: str,
    checkpoint: str,
    as_of: dt.date,
    location: str | None = None,
    processing_date: dt.date | None = None,
    cfg: RuleConfig = RuleConfig(),
    alerts: bool = False,
    rejects: str | None = None,
) -> dict[str, DataFrame]:
    """Tables, landing, enrichment, reports. No reports when there is no data."""
    spark = messages.sparkSession
    warehouse.create_tables(spark, database, location)
    land(messages, database, checkpoint, rejects)
    if not process(spark, database, processing_date, cfg, alerts):
        return {}
    return batch_reports(warehouse.table(spark, database, warehouse.PROCESSED), as_of)


def run_batch_and_training(
    messages: DataFrame,
    database: str,
    checkpoint: str,
    as_of: dt.date,
    model_folder: str,
    location: str | None = None,
    processing_date: dt.date | None = None,
    cfg: RuleConfig = RuleConfig(),
    alerts: bool = False,
    rejects: str | None = None,
    **training: int,
) -> tuple[dict[str, DataFrame], Trained | None]:
    """A batch run, then training on the table it wrote, by the same rules."""
    reports = run_batch(
        messages, database, checkpoint, as_of, location, processing_date, cfg, alerts, rejects
    )
    processed = warehouse.table(messages.sparkSession, database, warehouse.PROCESSED)
    return reports, run_training(processed, model_folder, cfg, **training)
