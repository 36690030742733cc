"""One staged view per subsidiary: the canonical fact columns plus its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.codes import loan_status
from ..functions.keys import surrogate_key
from ..schemas import LEDGER_CODE, MONEY


def _or_default(df: DataFrame, column: str, default: str) -> Column:
    if column not in df.columns:
        return F.lit(default)
    return F.coalesce(F.col(column), F.lit(default))


def _canonical(
    raw: DataFrame,
    subsidiary: str,
    revenue_code: str,
    key: Column,
    customer: str,
    day: str,
    amount: str,
    loaded: str,
    *own: Column | str,
) -> DataFrame:
    return raw.select(
        key.alias("transaction_nk"),
        F.lit(subsidiary).alias("subsidiary_code"),
        F.col(customer).alias("customer_id_nk"),
        F.col(day).cast("date").alias("transaction_date"),
        F.col(amount).cast(MONEY).alias("amount_local"),
        _or_default(raw, "currency", "PHP").alias("currency_code"),
        _or_default(raw, LEDGER_CODE, revenue_code).alias("gl_account_code"),
        *own,
        F.col(loaded).cast("timestamp_ntz").alias("_loaded_at"),
    )


def _day(name: str) -> Column:
    return F.col(name).cast("date").alias(name)


def retail(raw: DataFrame) -> DataFrame:
    return _canonical(
        raw, "SUB_A", "RETAIL_REVENUE", F.col("order_id"), "customer_id", "order_date",
        "net_sales", "updated_at",
        "product_sku", "channel", "category", "region", "qty", "unit_price", "discount_pct",
    )


def freight(raw: DataFrame) -> DataFrame:
    return _canonical(
        raw, "SUB_B", "FREIGHT_REVENUE", F.col("shipment_id"), "client_id", "ship_date",
        "total_revenue", "modified_ts",
        "origin_city", "dest_city", "service_type", "weight_kg", "volume_cbm",
        "freight_revenue", "fuel_surcharge", "delay_days",
        _day("expected_del"), _day("actual_del"),
    )


def loans(raw: DataFrame) -> DataFrame:
    """A loan may be reloaded under its id, so its key also takes the origination day."""
    key = surrogate_key(F.col("loan_id"), F.col("origination_date").cast("date"))
    return _canonical(
        raw, "SUB_C", "INTEREST_INCOME", key, "borrower_id", "origination_date",
        "outstanding_balance", "last_updated",
        "loan_type", "branch_id", "principal_amount", "interest_rate", "outstanding_balance",
        "monthly_payment", "term_months", _day("maturity_date"), "days_past_due",
        loan_status(F.col("loan_status")).alias("loan_status"),
    )


def orders(raw: DataFrame) -> DataFrame:
    """Order lines; the order number repeats, so the key takes the item too."""
    key = F.concat("order_num", F.lit("-"), "order_item")
    return _canonical(
        raw, "SUB_D", "MANUFACTURING_REVENUE", key, "customer_id", "order_date",
        "order_value_php", "change_date",
        "order_item", "doc_type", "sales_org", "material_id", "plant", "order_qty",
        F.col("delivered_qty").cast("int").alias("delivered_qty"), "net_price", "status",
        _day("requested_del"), _day("confirmed_del"),
    )


def leases(raw: DataFrame) -> DataFrame:
    """Leases have no change time; the start date stands in for it."""
    return _canonical(
        raw, "SUB_E", "RENTAL_INCOME", F.col("contract_id"), "tenant_id", "start_date",
        "annual_rent_php", "start_date",
        "property_id", "unit_type", "lease_type", "area_sqm", "term_years", _day("end_date"),
        "monthly_rent_php", "annual_rent_php", "security_deposit", "rent_escalation_pct",
        "status", "city",
    )


# Subsidiary to (raw table, staging function).
VIEWS = {
    "SUB_A": ("raw_sub_a_sales", retail),
    "SUB_B": ("raw_sub_b_shipments", freight),
    "SUB_C": ("raw_sub_c_loans", loans),
    "SUB_D": ("raw_sub_d_orders", orders),
    "SUB_E": ("raw_sub_e_leases", leases),
}

# Names of the stored views.
VIEW_NAMES = {
    "SUB_A": "stg_sub_a_sales",
    "SUB_B": "stg_sub_b_shipments",
    "SUB_C": "stg_sub_c_loans",
    "SUB_D": "stg_sub_d_orders",
    "SUB_E": "stg_sub_e_leases",
}
