"""Exchange-rate preparation and currency conversion."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.numbers import rounded
from ..schemas import FX_RATE
from .joins import bounded

HOME_CURRENCY = "PHP"

# Quote column to currency.
TICKERS = {
    "USDPHP=X": "USD",
    "SGDPHP=X": "SGD",
    "EURPHP=X": "EUR",
    "JPYPHP=X": "JPY",
    "CNYPHP=X": "CNY",
}


def quote_intervals(quotes: DataFrame, start: date, end_exclusive: date, day: str) -> DataFrame:
    """(from_currency, quote, first_day, end_day) from (day, from_currency, quote): each quote
    is valid until the next one's day. A currency's first quote also holds from ``start`` on,
    its last one to the end; the last quote before ``start`` holds there, too.

    The windows hold one currency's quotes, one a day at most."""
    known = quotes.filter(F.col("quote").isNotNull() & (F.col(day) < F.lit(end_exclusive)))
    daily = known.groupBy("from_currency", day).agg(F.max("quote").alias("quote"))
    in_order = Window.partitionBy("from_currency").orderBy(day)
    begins = F.when(F.lag(day).over(in_order).isNull(), F.lit(start)).otherwise(
        F.greatest(F.col(day), F.lit(start))
    )
    ends = F.coalesce(F.lead(day).over(in_order), F.lit(end_exclusive))
    return daily.select(
        "from_currency", "quote", begins.alias("first_day"), ends.alias("end_day")
    ).filter(F.col("first_day") < F.col("end_day"))


def prepare_rates(
    quotes: DataFrame,
    start: date,
    end_exclusive: date,
    tickers: Mapping[str, str] = TICKERS,
    day: str = "rate_date",
) -> DataFrame:
    """Daily rates from a wide table of quotes (home units per one foreign unit).

    Quote columns are renamed and unpivoted. Every currency gets a row for every day from
    ``start`` to the end, which is left out: days without a quote take the last earlier one,
    leading days the first later one, and a currency without any quote gets NULLs. Without a
    quote in any currency there are no rows. Later quotes than the end play no part.
    """
    currencies = list(tickers.values())
    named = quotes.withColumnsRenamed(dict(tickers))
    long = named.unpivot([day], currencies, "from_currency", "quote").filter(
        F.col("from_currency").isin(currencies)
    )
    held = quote_intervals(long, start, end_exclusive, day)
    span = held.agg(F.lit(start).alias("first_day"), F.lit(end_exclusive).alias("end_day"), F.count("*").alias("n"))
    listed = F.explode(F.array(*[F.lit(c) for c in currencies])).alias("from_currency")
    unquoted = span.filter("n > 0").select(listed, F.col("first_day"), F.col("end_day")).join(
        held.select("from_currency").distinct(), "from_currency", "left_anti"
    )
    daily = held.unionByName(unquoted, allowMissingColumns=True).select(
        "from_currency",
        "quote",
        F.explode(F.sequence("first_day", F.date_sub("end_day", 1))).alias("rate_date"),
    )
    per_home = F.lit(1.0) / F.nullif(F.col("quote").cast("double"), F.lit(0.0))
    return daily.select(
        "rate_date",
        "from_currency",
        F.lit(HOME_CURRENCY).alias("to_currency"),
        rounded(per_home, 8).cast(FX_RATE["rate"].dataType).alias("rate"),
        F.round(F.col("quote"), 6).cast(FX_RATE["usd_php_rate"].dataType).alias("usd_php_rate"),
    ).orderBy("from_currency", "rate_date")


def with_rate(facts: DataFrame, rates: DataFrame, rate_rows: int, *columns: str) -> DataFrame:
    """Facts with the rate columns of their day and currency, NULL where there is none."""
    lookup = rates.select(
        F.col("rate_date").alias("transaction_date"),
        F.col("from_currency").alias("currency_code"),
        *columns,
    )
    return facts.join(bounded(lookup, rate_rows), ["transaction_date", "currency_code"], "left")


def to_home_currency(facts: DataFrame, rates: DataFrame, rate_rows: int) -> DataFrame:
    """Add amount_php: home amounts as they are, others divided by the day's rate.

    Without a rate it is NULL. An amount that does not fit its column fails the job, so that
    none is lost unseen.
    """
    converted = rounded(
        F.col("amount_local").cast("double")
        / F.nullif(F.col("rate").cast("double"), F.lit(0.0)),
        2,
    )
    home = F.col("currency_code") == HOME_CURRENCY
    amount = F.when(home, F.col("amount_local").cast("decimal(18,2)")).otherwise(
        converted.cast("decimal(18,2)")
    )
    return (
        with_rate(facts, rates, rate_rows, "rate").withColumn("amount_php", amount).drop("rate")
    )
