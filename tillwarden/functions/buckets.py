"""Rates and the named ranges the reports group by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole`` as DOUBLE with two decimals."""
    return F.round(F.try_divide(part.cast("double") * 100, whole), 2)


def amount_band(amount: Column) -> Column:
    """Left-closed bands; 5000 exactly and NULL belong to the last one."""
    return (
        F.when(amount < 100, "< $100")
        .when(amount < 500, "$100 - $500")
        .when(amount < 1000, "$500 - $1000")
        .when(amount < 5000, "$1000 - $5000")
        .otherwise("> $5000")
    )


def activity_level(transactions: Column) -> Column:
    return (
        F.when(transactions < 10, "Low Activity")
        .when(transactions < 50, "Medium Activity")
        .otherwise("High Activity")
    )
