"""Calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import calendar_attributes


def days(spark: SparkSession, start: date, end_exclusive: date) -> DataFrame:
    """One row per day, the end left out."""
    bounds = spark.range(1).select(
        F.lit(start).alias("first_day"), F.lit(end_exclusive).alias("end_day")
    )
    return days_between(bounds)


def days_between(bounds: DataFrame) -> DataFrame:
    """Days of the one-row relation (first_day, end_day), the end left out."""
    last = F.date_sub(F.col("end_day"), 1)
    return bounds.select(F.explode(F.sequence("first_day", last)).alias("day"))


def calendar(spark: SparkSession, start: date, end_exclusive: date) -> DataFrame:
    return days(spark, start, end_exclusive).select(*calendar_attributes(F.col("day")))


def calendar_covering(dates: DataFrame, column: str) -> DataFrame:
    """Calendar of every whole year that the date column touches."""
    bounds = dates.agg(
        F.trunc(F.min(column), "YEAR").alias("first_day"),
        F.add_months(F.trunc(F.max(column), "YEAR"), 12).alias("end_day"),
    )
    return days_between(bounds).select(*calendar_attributes(F.col("day")))
