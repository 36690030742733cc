"""Ingestion control: which sources are active, what is new, where the marks go."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

WARN_HOURS, ERROR_HOURS = 25, 49


def active(config: DataFrame) -> DataFrame:
    return config.filter("active")


def load_times(tables: Mapping[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """(subsidiary_code, target_table, loaded) for every row of every raw table; a table
    without an incremental column gives NULLs. Only those columns are read."""
    parts = [
        df.select(
            F.col("_subsidiary_code").alias("subsidiary_code"),
            F.lit(name).alias("target_table"),
            (F.col(column) if column else F.lit(None)).cast("timestamp_ntz").alias("loaded"),
        )
        for name, (df, column) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _is_new() -> Column:
    incremental = (
        (F.col("load_strategy") == "INCREMENTAL")
        & F.col("incremental_column").isNotNull()
        & F.col("last_loaded_at").isNotNull()
    )
    return F.when(incremental, F.col("loaded") > F.col("last_loaded_at")).otherwise(True)


SOURCE = ["subsidiary_code", "target_table"]


def new_row_counts(config: DataFrame, times: DataFrame) -> DataFrame:
    """New rows per active source: its subsidiary's rows past the mark, or all of its rows
    of a full load. Rows of other subsidiaries in the same table do not count."""
    counted = times.join(active(config), SOURCE)
    counts = counted.groupBy(*SOURCE).agg(F.count_if(_is_new()).alias("new_rows"))
    return active(config).join(counts, SOURCE, "left").select(
        "subsidiary_code",
        "target_table",
        "load_strategy",
        F.coalesce("new_rows", F.lit(0)).cast("bigint").alias("new_rows"),
    )


def advance_marks(config: DataFrame, times: DataFrame, as_of: datetime) -> DataFrame:
    """Config with the marks moved to what was really seen.

    An incremental source moves to its greatest load time and never back; a full
    load is stamped with the run's own time; inactive sources stay.
    """
    seen = (
        times.join(active(config).select(*SOURCE), SOURCE)
        .groupBy(*SOURCE)
        .agg(F.max("loaded").alias("_seen"))
    )
    run = F.lit(as_of).cast("timestamp_ntz")
    incremental = (F.col("load_strategy") == "INCREMENTAL") & F.col(
        "incremental_column"
    ).isNotNull()
    moved = (
        F.when(~F.col("active"), F.col("last_loaded_at"))
        .when(incremental, F.greatest("last_loaded_at", "_seen"))
        .otherwise(run)
    )
    return (
        config.join(seen, SOURCE, "left")
        .withColumn("last_loaded_at", moved)
        .select(*config.columns)
    )


def freshness(times: DataFrame, as_of: datetime) -> DataFrame:
    """Age of each table's last load: pass, warn after 25 hours, error after 49."""
    last = times.groupBy("target_table").agg(F.max("loaded").alias("last_loaded"))
    now = F.lit(as_of).cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", F.col("last_loaded"), now)
    status = (
        F.when(F.col("last_loaded").isNull(), "error")
        .when(F.col("age_seconds") > ERROR_HOURS * 3600, "error")
        .when(F.col("age_seconds") > WARN_HOURS * 3600, "warn")
        .otherwise("pass")
    )
    return last.withColumn("age_seconds", seconds).withColumn("status", status)
