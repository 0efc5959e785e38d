"""Ratios and sums of amounts. Sums stay exact decimals; only the division is done in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """NULL when ``whole`` is NULL or zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def ones(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is unknown)."""
    return F.when(condition, 1).otherwise(0)


def total(amount: Column) -> Column:
    """Sum of doubles that doesn't depend on their order where that is possible.

    While all amounts of a group are numbers with up to six decimals, their sum is
    taken in decimals, which is exact, and given as the nearest double. As soon as one
    has more decimals, is too large for that, or is not finite, the sum is that of the
    doubles as they are: nothing is rounded or left out, and Infinity and NaN show.
    """
    exact = amount.try_cast("decimal(28,6)")
    fits = F.coalesce(exact.cast("double") == amount, amount.isNull())
    return F.when(F.bool_and(fits), F.sum(exact).cast("double")).otherwise(F.sum(amount.cast("double")))
