"""Sums and means of amounts that lose no value and do not depend on row order.

Doubles add up differently for every partitioning, so a mean that ends in half
a cent could round either way on a rerun. Ordinary amounts are added as
decimals, exactly and as they are, sub-cent parts included. NaN, infinite and
very large amounts are added as doubles: no amount is left out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Amounts below this are added as decimals of 26 digits before the point; a sum
# that needs more raises.
LARGE = 1e16
EXACT = "decimal(38,12)"


# A mean is one division of whole numbers where amounts have up to four decimals,
# and so as near as a double can be.
PARTS = 10_000


def parts(amount: str | Column) -> tuple[Column, Column, Column]:
    """The exact sum of ordinary amounts, the sum of all others, and how many there are."""
    x = F.col(amount) if isinstance(amount, str) else amount
    ordinary = F.abs(x) < LARGE  # NaN compares as larger than any number
    exact = F.coalesce(F.sum(F.when(ordinary, x).cast(EXACT)), F.lit(0).cast(EXACT))
    other = F.coalesce(F.sum(F.when(~ordinary, x)), F.lit(0.0))
    return exact, other, F.count(x)


def total(amount: str | Column) -> Column:
    """The sum as DOUBLE; NULL when there is no amount, NaN when one is NaN."""
    exact, other, n = parts(amount)
    return F.when(n > 0, exact.cast("double") + other)


def mean(amount: str | Column) -> Column:
    """Mean over the non-null amounts; NULL when there is none."""
    return mean_of(*parts(amount))


def mean_of(exact: Column, other: Column, n: Column) -> Column:
    """The mean from the :func:`parts` of the amounts, or from sums of such parts."""
    whole = (exact * PARTS).cast("double")
    return F.try_divide(whole, n * PARTS) + F.try_divide(other, n)


def rounded_mean(amount: str | Column) -> Column:
    """Mean rounded half-up to cents."""
    return F.round(mean(amount), 2)
