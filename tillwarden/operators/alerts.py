"""Alerts from single transactions and from bursts of them, for batch and stream."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwarden import schemas
from tillwarden.config import RAPID_TRANSACTIONS, RuleConfig
from tillwarden.functions import rules
from tillwarden.functions.calendar import with_event_time
from tillwarden.operators.enrich import with_processing_date

POINT_COLUMNS = [
    "alert_id",
    "alert_type",
    "transaction_id",
    "user_id",
    "amount",
    "merchant_id",
    "location",
    "timestamp",
    "alert_timestamp",
    "severity",
    "processing_date",
]


def point_alerts(
    transactions: DataFrame,
    cfg: RuleConfig = RuleConfig(),
    only: Iterable[str] | None = None,
) -> DataFrame:
    """One alert per broken rule, all rules judged in a single pass over the rows."""
    conditions = rules.point_rules(cfg)
    if only is not None:
        conditions = {kind: conditions[kind] for kind in only}
    broken = F.array_compact(
        F.array(*[F.when(holds, kind) for kind, holds in conditions.items()])
    )
    any_rule = F.lit(False)
    for holds in conditions.values():
        any_rule = any_rule | holds
    alerts = (
        with_processing_date(transactions)
        .where(any_rule)
        .withColumn("alert_type", F.explode(broken))
    )
    return alerts.withColumns(
        {
            "alert_id": rules.row_id(
                "transaction_id", "user_id", "amount", "merchant_id", "location", "timestamp"
            ),
            "alert_timestamp": F.current_timestamp(),
            "severity": rules.severity(F.col("alert_type"), F.col("amount"), cfg),
        }
    ).select(*POINT_COLUMNS)


def rapid_alerts(
    transactions: DataFrame, cfg: RuleConfig = RuleConfig(), time_column: str = "event_time"
) -> DataFrame:
    """One alert per user and tumbling window with more than ``rapid_limit`` rows.

    State per user-window is a count and the latest row, never the rows. The
    count is merged before the shuffle, so a very busy user costs no more.
    ``time_column`` is the event time, or the broker's arrival time.
    """
    rows = transactions.where(F.col("user_id").isNotNull())
    slot = F.window(time_column, cfg.rapid_window)
    if not transactions.isStreaming:
        return burst_alerts(bursts(rows, slot["start"], cfg, time_column), cfg)
    # A stream needs the whole window as its key, to match the watermark.
    last = F.max_by("transaction_id", F.struct(time_column, "transaction_id"))
    windows = rows.groupBy(slot.alias("slot"), "user_id").agg(
        F.count("*").alias("transaction_count"), last.alias("last_transaction_id")
    )
    return burst_alerts(windows.withColumn("start", F.col("slot.start")), cfg)


def bursts(rows: DataFrame, start: Column, cfg: RuleConfig, time_column: str) -> DataFrame:
    """Windows with too many rows, with the id of the latest row, and of rows alike in time the largest id.

    The first step keeps a count and a time, which a hash aggregate holds in place.
    Ids are looked up only for windows over the limit, among the rows of their last
    moment; the join spreads a busy user by that moment and builds its table from
    the bursts, so that no rows are sorted.
    """
    rows = rows.select("user_id", "transaction_id", F.col(time_column).alias("at"), start.alias("start"))
    counted = rows.groupBy("start", "user_id").agg(
        F.count("*").alias("transaction_count"), F.max("at").alias("at")
    )
    over = counted.where(F.col("transaction_count") > cfg.rapid_limit)
    keys = ["start", "user_id", "at"]
    # The count goes along as a key: it follows from the others.
    return (
        rows.join(over.hint("shuffle_hash"), keys)
        .groupBy(*keys, "transaction_count")
        .agg(F.max("transaction_id").alias("last_transaction_id"))
    )


def burst_alerts(windows: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    """Alerts of windows (``start, user_id, transaction_count, last_transaction_id``) over the limit."""
    start = F.col("start")
    return windows.where(F.col("transaction_count") > cfg.rapid_limit).select(
        rules.stable_id(
            F.lit(RAPID_TRANSACTIONS), "user_id", F.date_format(start, "yyyy-MM-dd'T'HH:mm:ss")
        ).alias("alert_id"),
        F.lit(RAPID_TRANSACTIONS).alias("alert_type"),
        "user_id",
        F.current_timestamp().alias("alert_timestamp"),
        F.lit("HIGH").alias("severity"),
        "transaction_count",
        F.lit(cfg.rapid_window.replace(" ", "_")).alias("time_window"),
        "last_transaction_id",
        F.to_date(start).alias("processing_date"),
    )


def all_alerts(
    transactions: DataFrame, cfg: RuleConfig = RuleConfig(), time_column: str = "event_time"
) -> DataFrame:
    """Every alert in the layout of the alert table, duplicates kept."""
    rows = with_event_time(transactions)
    both = point_alerts(rows, cfg).unionByName(
        rapid_alerts(rows, cfg, time_column), allowMissingColumns=True
    )
    return in_table_layout(both)


def in_table_layout(alerts: DataFrame) -> DataFrame:
    """The columns of the alert table; those an alert lacks are null."""
    columns = {f.name: F.col(f.name) if f.name in alerts.columns else F.lit(None) for f in schemas.ALERT_TABLE}
    return alerts.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in schemas.ALERT_TABLE]
    )
