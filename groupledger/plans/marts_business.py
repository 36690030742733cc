"""Marts over one subsidiary's staged view."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import month_start
from ..functions.numbers import average, money_sum, percent, ratio, sum_where, whole_sum
from ..operators.joins import bounded
from ..operators.windows import share_of_total
from ..schemas import MONEY_SUM
from .marts_group import PERIOD, in_period


def retail_sales(sales: DataFrame, calendar: DataFrame, days: int) -> DataFrame:
    """Monthly retail sales per channel, category and region."""
    gross = (F.col("unit_price") * F.col("qty")).cast("decimal(18,2)")
    monthly = (
        in_period(sales, calendar, days)
        .groupBy(*PERIOD, "channel", "category", "region")
        .agg(
            F.count("*").alias("order_count"),
            whole_sum("qty").alias("units_sold"),
            F.count_distinct("customer_id_nk").alias("unique_customers"),
            money_sum("amount_local").alias("net_sales_php"),
            money_sum(gross).alias("gross_sales_php"),
            money_sum(gross - F.col("amount_local")).alias("discount_amount_php"),
            average(F.col("discount_pct"), 2).alias("avg_discount_pct"),
        )
    )
    net = F.col("net_sales_php")
    return monthly.select(
        "*",
        ratio(net, F.col("unique_customers"), 2).alias("revenue_per_customer"),
        ratio(net, F.col("order_count"), 2).alias("avg_order_value"),
        share_of_total("net_sales_php", ["year", "month_num"]).alias(
            "channel_revenue_share_pct"
        ),
    ).orderBy("year", "month_num", "channel", net.desc_nulls_first())


FREIGHT_KEY = ("year", "month_num", "origin_city", "dest_city", "service_type")


def freight_ops(shipments: DataFrame, calendar: DataFrame, days: int) -> DataFrame:
    """Monthly shipments per route and service with on-time and delay figures."""
    delay = F.col("delay_days")
    route = F.concat("origin_city", F.lit(" → "), "dest_city")
    return (
        in_period(shipments, calendar, days)
        .groupBy(*PERIOD, "origin_city", "dest_city", route.alias("route"), "service_type")
        .agg(
            F.count("*").alias("shipment_count"),
            money_sum("weight_kg").alias("total_weight_kg"),
            money_sum("volume_cbm").alias("total_volume_cbm"),
            money_sum("freight_revenue").alias("freight_revenue_php"),
            money_sum("fuel_surcharge").alias("fuel_surcharge_php"),
            money_sum("amount_local").alias("total_revenue_php"),
            ratio(F.sum("amount_local"), F.sum("weight_kg"), 4).alias("revenue_per_kg"),
            F.count_if(delay == 0).alias("on_time_count"),
            percent(F.count_if(delay == 0), F.count("*")).alias("otd_rate_pct"),
            average(delay, 2).alias("avg_delay_days"),
            F.max(delay).alias("max_delay_days"),
            F.count_if(delay > 3).alias("severely_delayed_count"),
        )
    )


def _collected(
    staged: DataFrame, code: str, amount: str, lag: str | None, grace_days: int
) -> DataFrame:
    """Billed and collected amounts per month; without a lag all is on time."""
    late = F.col(lag) if lag else F.lit(0)
    value = F.col(amount)
    return staged.groupBy(month_start(F.col("transaction_date")).alias("billed_month")).agg(
        F.lit(code).alias("subsidiary_code"),
        money_sum(value).alias("billed_php"),
        average(late, 1).alias("avg_dso_days"),
        sum_where(late == 0, value).alias("collected_on_time_php"),
        sum_where(late.between(1, grace_days), value).alias("collected_1_7d_php"),
        sum_where(late > grace_days, value).alias("collected_7d_plus_php"),
    )


def cash_collection(
    sales: DataFrame, shipments: DataFrame, loans: DataFrame, calendar: DataFrame, days: int
) -> DataFrame:
    """Monthly billing and collection: retail is paid at once, freight by delivery
    delay, lending by days past due of the loans still open."""
    open_loans = loans.filter(F.col("loan_status") != "CLOSED")
    billed = reduce(
        DataFrame.unionByName,
        [
            _collected(sales, "SUB_A", "amount_local", None, 7),
            _collected(shipments, "SUB_B", "amount_local", "delay_days", 7),
            _collected(open_loans, "SUB_C", "monthly_payment", "days_past_due", 30),
        ],
    )
    months = calendar.select(F.col("date_key").alias("billed_month"), *PERIOD)
    rest = F.col("billed_php") - F.col("collected_on_time_php") - F.col("collected_1_7d_php")
    return (
        billed.join(bounded(months, days), "billed_month")
        .select(
            *PERIOD,
            "subsidiary_code",
            "billed_php",
            "collected_on_time_php",
            "collected_1_7d_php",
            "collected_7d_plus_php",
            "avg_dso_days",
            percent(F.col("collected_on_time_php"), F.col("billed_php")).alias(
                "on_time_collection_rate_pct"
            ),
            F.round(rest, 2).cast(MONEY_SUM).alias("est_outstanding_php"),
        )
        .orderBy("year", "month_num", "subsidiary_code")
    )


# Portfolio status to its count column.
STATUS_COUNTS = {
    "CURRENT": "current_count",
    "GRACE_PERIOD": "grace_period_count",
    "30DPD": "dpd_30_count",
    "60DPD": "dpd_60_count",
    "90DPD": "dpd_90_count",
    "NPL": "npl_count",
    "RESTRUCTURED": "restructured_count",
    "CHARGED_OFF": "charged_off_count",
}


def loan_portfolio(loans: DataFrame) -> DataFrame:
    """Open loans per type and branch: status buckets, bad-loan rate, balance at risk."""
    status, balance = F.col("loan_status"), F.col("outstanding_balance")
    at_risk = status.isin("90DPD", "NPL")
    buckets = [F.count_if(status == s).alias(name) for s, name in STATUS_COUNTS.items()]
    return (
        loans.filter(status != "CLOSED")
        .groupBy("loan_type", "branch_id")
        .agg(
            F.count("*").alias("loan_count"),
            money_sum("principal_amount").alias("total_principal_php"),
            money_sum(balance).alias("total_outstanding_php"),
            average(F.col("interest_rate"), 2).alias("avg_interest_rate_pct"),
            average(F.col("term_months"), 0).alias("avg_term_months"),
            *buckets,
            percent(F.count_if(status == "NPL"), F.count("*")).alias("npl_rate_pct"),
            sum_where(at_risk, balance).alias("balance_at_risk_php"),
            percent(sum_where(at_risk, balance), F.sum(balance)).alias("balance_at_risk_pct"),
        )
    )


# Order status to its count column.
ORDER_COUNTS = {
    "DELIVERED": "delivered_count",
    "BILLED": "billed_count",
    "OPEN": "open_count",
    "CANCELLED": "cancelled_count",
}


def order_fulfillment(orders: DataFrame, calendar: DataFrame, days: int) -> DataFrame:
    """Monthly order lines per plant, sales organisation and document type."""
    status = F.col("status")
    lead = F.date_diff(F.col("confirmed_del"), F.col("transaction_date"))
    counts = [F.count_if(status == s).alias(name) for s, name in ORDER_COUNTS.items()]
    return (
        in_period(orders.withColumn("lead_days", lead), calendar, days)
        .groupBy(*PERIOD, "plant", "sales_org", "doc_type")
        .agg(
            F.count("*").alias("order_count"),
            whole_sum("order_qty").alias("total_order_qty"),
            whole_sum("delivered_qty").alias("total_delivered_qty"),
            money_sum("amount_local").alias("order_value_php"),
            ratio(F.sum("amount_local"), F.count("*"), 2).alias("avg_order_value_php"),
            percent(F.sum("delivered_qty"), F.sum("order_qty")).alias("fill_rate_pct"),
            *counts,
            percent(F.count_if(status == "CANCELLED"), F.count("*")).alias(
                "cancellation_rate_pct"
            ),
            average(F.col("lead_days"), 1).alias("avg_lead_time_days"),
        )
        .orderBy("year", "month_num", "plant", "sales_org", "doc_type")
    )


def lease_portfolio(leases: DataFrame, as_of: date) -> DataFrame:
    """Leases per type, unit and city: occupancy, rent roll, leases about to end."""
    active: Column = F.col("status") == "ACTIVE"
    rent, escalation = F.col("monthly_rent_php"), F.col("rent_escalation_pct")
    ending = active & (F.date_diff(F.col("end_date"), F.lit(as_of)) <= 90)
    weighted = F.sum(F.when(active, escalation * rent).otherwise(F.lit(0)))
    return leases.groupBy("lease_type", "unit_type", "city").agg(
        F.count("*").alias("total_units"),
        F.count_if(active).alias("occupied_units"),
        F.count_if(F.col("status") == "EXPIRED").alias("vacant_units"),
        percent(F.count_if(active), F.count("*")).alias("occupancy_rate_pct"),
        money_sum("area_sqm").alias("total_area_sqm"),
        sum_where(active, F.col("area_sqm")).alias("occupied_area_sqm"),
        sum_where(active, rent).alias("monthly_rent_roll_php"),
        sum_where(active, F.col("annual_rent_php")).alias("arr_php"),
        money_sum("security_deposit").alias("total_deposits_held_php"),
        ratio(weighted, sum_where(active, rent), 2).alias("wtd_avg_escalation_pct"),
        F.count_if(ending).alias("expiring_90d_count"),
        sum_where(ending, rent).alias("expiring_90d_monthly_rent_php"),
    )
