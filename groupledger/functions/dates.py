"""Calendar arithmetic on DATE columns."""

from pyspark.sql import Column, functions as F


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_boundaries(start: Column, end: Column) -> Column:
    """How many month starts lie in (start, end]; the day of the month plays no part."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def calendar_attributes(day: Column) -> list[Column]:
    """The twelve attributes of a calendar day, Sunday being day 1 of the week."""
    return [
        day.alias("date_key"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month_num"),
        F.date_format(day, "MMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),
        F.date_format(day, "E").alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.date_format(day, "yyyy-'Q'Q").alias("year_quarter"),
    ]
