"""Sums, ratios and averages that round the same way on every engine.

Amounts are decimals, so their sums do not depend on the order of rows. A ratio
is one double division; it goes through a wide decimal before it is rounded, so
that the half-up step never sees the binary noise of the division.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import MONEY_SUM


def money_sum(col: Column | str) -> Column:
    return F.sum(col).cast(MONEY_SUM)


def whole_sum(col: Column | str) -> Column:
    return F.sum(col).cast("bigint")


def rounded(value: Column, digits: int) -> Column:
    return F.round(value.cast("decimal(38,12)"), digits).cast("double")


def ratio(num: Column, den: Column, digits: int) -> Column:
    """num / den, NULL for a zero denominator."""
    return rounded(num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0)), digits)


def percent(num: Column, den: Column, digits: int = 2) -> Column:
    return rounded(
        num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0)) * F.lit(100.0), digits
    )


def average(col: Column, digits: int) -> Column:
    """Mean of the non-NULL values from an exact sum and a count."""
    return ratio(F.sum(col), F.count(col), digits)


def sum_where(condition: Column, value: Column) -> Column:
    """Sum of value over the rows that meet the condition, 0 when none do."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0))).cast(MONEY_SUM)
