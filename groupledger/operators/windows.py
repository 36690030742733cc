"""Period growth, shares of a total and ranks over grouped results.

All of them take the output of a groupBy, so a window partition holds grouped
rows (one per reporting key), never raw facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.numbers import percent


def share_of_total(value: str, within: Sequence[str]) -> Column:
    total = F.sum(value).over(Window.partitionBy(*within))
    return percent(F.col(value), total)


def with_growth(
    df: DataFrame, value: str, per: Sequence[str], order: Sequence[str], out: str
) -> DataFrame:
    """Percent change against the previous existing period of the same key."""
    before = F.lag(value).over(Window.partitionBy(*per).orderBy(*order))
    return (
        df.withColumn("_before", before)
        .withColumn(out, percent(F.col(value) - F.col("_before"), F.col("_before")))
        .drop("_before")
    )


def rank_desc(value: str, within: Sequence[str]) -> Column:
    """Rank by falling value; ties share a rank and NULL comes first."""
    return F.rank().over(
        Window.partitionBy(*within).orderBy(F.col(value).desc_nulls_first())
    )
