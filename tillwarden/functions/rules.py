"""The fraud rules, the label and the severity as plain column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwarden import config as fixed
from tillwarden.config import RuleConfig


def is_high_amount(cfg: RuleConfig) -> Column:
    return F.col("amount") > cfg.high_amount


def is_unknown_location(cfg: RuleConfig) -> Column:
    return F.col("location") == cfg.unknown_location


def is_odd_hour(cfg: RuleConfig) -> Column:
    at_night = F.col("hour_of_day").between(cfg.odd_hour_from, cfg.odd_hour_to)
    return at_night & (F.col("amount") > cfg.odd_hour_amount)


def point_rules(cfg: RuleConfig) -> dict[str, Column]:
    """Alert type of each rule that looks at one transaction, with its condition."""
    return {
        fixed.HIGH_AMOUNT: is_high_amount(cfg),
        fixed.UNUSUAL_LOCATION: is_unknown_location(cfg),
        fixed.UNUSUAL_HOUR: is_odd_hour(cfg),
    }


def breaks_any(cfg: RuleConfig) -> Column:
    """One flat OR of comparisons, so that a Parquet scan can skip row groups by it."""
    return reduce(or_, point_rules(cfg).values())


def fraud_label(cfg: RuleConfig) -> Column:
    """1 when any point rule holds; an unknown answer counts as 0."""
    return F.when(breaks_any(cfg), 1).otherwise(0)


def severity(alert_type: Column, amount: Column, cfg: RuleConfig) -> Column:
    very_high = (alert_type == fixed.HIGH_AMOUNT) & (amount > cfg.critical_amount)
    unusual = alert_type.isin(fixed.UNUSUAL_LOCATION, fixed.UNUSUAL_HOUR)
    return (
        F.when(very_high, "CRITICAL")
        .when(alert_type == fixed.RAPID_TRANSACTIONS, "HIGH")
        .when(unusual, "MEDIUM")
        .otherwise("LOW")
    )


def row_id(key: str, *others: str) -> Column:
    """An id by the alert type and a row's key; without a key, by all its other fields.

    The second form keeps nulls apart from text and fields apart from each other.
    """
    fields = F.to_json(F.struct("alert_type", *others), {"ignoreNullFields": "false"})
    return F.when(F.col(key).isNotNull(), stable_id("alert_type", key)).otherwise(
        F.sha2(fields, 256)
    )


def stable_id(*parts: str | Column) -> Column:
    """The same alert gets the same id on every rerun."""
    return F.sha2(F.concat_ws("|", *parts), 256)
