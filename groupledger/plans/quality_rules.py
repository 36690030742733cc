"""Declared rules of every table, and the two checks across tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from itertools import combinations
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.fx import TICKERS
from ..operators.quality import Accepted, Between, HasType, Holds, NotNull, Related, Unique
from ..schemas import (
    ACCOUNT, AUDIT, BRONZE, CUSTOMER, FX_RATE, GL_MAPPING, PRODUCT, SUBSIDIARY, TRANSACTION,
)
from ..sources.reference_rows import CODES, SUBSIDIARIES
from .marts_group import REVENUE_CODES, interco_postings

CANONICAL = (
    "transaction_nk", "subsidiary_code", "customer_id_nk", "transaction_date", "amount_local",
    "currency_code", "gl_account_code", "_loaded_at",
)
CURRENCIES = tuple(TICKERS.values())


def _all(columns: Sequence[str]) -> list[NotNull]:
    return [NotNull(c) for c in columns]


def _bronze(table: str) -> list[NotNull]:
    return _all([*BRONZE[table].names, *AUDIT.names])


# Ranges, allowed values and keys of the raw tables.
BRONZE_RULES: dict[str, list[Any]] = {
    "raw_sub_a_sales": [
        *_bronze("raw_sub_a_sales"),
        Unique("order_id"),
        Between("qty", 1, 10),
        Between("unit_price", 100, 5000),
        Between("net_sales", 0, 50000),
    ],
    "raw_sub_a_customers": [*_bronze("raw_sub_a_customers"), Unique("customer_id")],
    "raw_sub_b_shipments": [
        *_bronze("raw_sub_b_shipments"),
        Unique("shipment_id"),
        Between("delay_days", 0, 30),
        Between("weight_kg", 0.01, 30000),
        Between("volume_cbm", 0.001, 500),
        Between("freight_revenue", 0, 5000000),
        Between("total_revenue", 0, 5000000),
    ],
    "raw_sub_c_loans": [
        *_bronze("raw_sub_c_loans"),
        Unique("loan_id"),
        Between("term_months", 6, 360),
        Between("principal_amount", 10000, 50000000),
        Between("interest_rate", 0, 100),
        Between("outstanding_balance", 0, 50000000),
        Between("monthly_payment", 0, 1000000),
        Between("days_past_due", 0, 120),
    ],
    "raw_sub_d_orders": [
        *_bronze("raw_sub_d_orders"),
        Between("order_qty", 1, 10000),
        Between("delivered_qty", 0, 10000),
        Between("net_price", 50, 10000),
        Between("order_value_php", 0, 100000000),
    ],
    "raw_sub_e_leases": [
        *_bronze("raw_sub_e_leases"),
        Unique("contract_id"),
        Between("area_sqm", 20, 2000),
        Between("term_years", 1, 10),
        Between("monthly_rent_php", 5000, 500000),
        Between("annual_rent_php", 60000, 6000000),
        Between("security_deposit", 10000, 1000000),
        Between("rent_escalation_pct", 3, 8),
    ],
}


def _staged(code: str, revenue: str, low: int, high: int, *own: str) -> list[Any]:
    return [
        *_all([*CANONICAL, *own]),
        Accepted("subsidiary_code", (code,)),
        HasType("transaction_date", "date"),
        Between("amount_local", low, high),
        Accepted("currency_code", ("PHP",)),
        Accepted("gl_account_code", (revenue,)),
    ]


# Ranges and allowed values of the staged views.
STAGING_RULES: dict[str, list[Any]] = {
    "stg_sub_a_sales": [
        *_staged(
            "SUB_A", "RETAIL_REVENUE", 0, 50000,
            "product_sku", "channel", "category", "region", "qty", "unit_price", "discount_pct",
        ),
        Unique("transaction_nk"),
        Between("qty", 1, 10),
        Between("unit_price", 100, 5000),
        Accepted("discount_pct", (0, 5, 10, 15, 20)),
    ],
    "stg_sub_b_shipments": [
        *_staged(
            "SUB_B", "FREIGHT_REVENUE", 500, 200000,
            "origin_city", "dest_city", "service_type", "weight_kg", "volume_cbm",
            "freight_revenue", "fuel_surcharge", "delay_days", "expected_del", "actual_del",
        ),
        Unique("transaction_nk"),
        Between("weight_kg", 10, 5000),
        Between("volume_cbm", 0.1, 50),
        Between("delay_days", 0, 30),
    ],
    "stg_sub_c_loans": [
        *_staged(
            "SUB_C", "INTEREST_INCOME", 0, 5000000,
            "loan_type", "branch_id", "principal_amount", "interest_rate",
            "outstanding_balance", "monthly_payment", "term_months", "maturity_date",
            "days_past_due", "loan_status",
        ),
        Unique("transaction_nk"),
        Between("principal_amount", 10000, 5000000),
        Between("interest_rate", 4.5, 24.0),
        Between("days_past_due", 0, 365),
        Accepted(
            "loan_status",
            ("CURRENT", "GRACE_PERIOD", "30DPD", "60DPD", "90DPD", "NPL", "RESTRUCTURED",
             "CHARGED_OFF", "CLOSED"),
        ),
    ],
    "stg_sub_d_orders": [
        *_staged(
            "SUB_D", "MANUFACTURING_REVENUE", 0, 100000000,
            "order_item", "doc_type", "sales_org", "material_id", "plant", "order_qty",
            "delivered_qty", "net_price", "status", "requested_del", "confirmed_del",
        ),
        Between("order_qty", 10, 1000),
        Accepted("status", ("OPEN", "DELIVERED", "BILLED", "CANCELLED")),
    ],
    "stg_sub_e_leases": [
        *_staged(
            "SUB_E", "RENTAL_INCOME", 60000, 6000000,
            "property_id", "unit_type", "lease_type", "area_sqm", "term_years", "end_date",
            "monthly_rent_php", "annual_rent_php", "security_deposit", "rent_escalation_pct",
            "status", "city",
        ),
        Unique("transaction_nk"),
        Between("area_sqm", 20, 2000),
        Accepted("term_years", (1, 2, 3, 5, 10)),
        Between("rent_escalation_pct", 3, 8),
        Accepted("status", ("ACTIVE", "EXPIRED")),
        Accepted("city", ("Makati", "BGC", "Cebu City", "Davao City")),
    ],
}

# Rules of the seeds and entities.
INTEGRATION_RULES: dict[str, list[Any]] = {
    "fx_rates": [
        *_all(FX_RATE.names),
        Accepted("from_currency", CURRENCIES),
        Accepted("to_currency", ("PHP",)),
        Between("rate", 0.0001, 10000),
    ],
    "gl_account_mapping": [
        *_all(GL_MAPPING.names),
        Accepted("subsidiary_code", CODES),
        Unique("subsidiary_gl_code"),
        Accepted("gl_category", ("REVENUE", "COGS", "OPEX")),
    ],
    "ent_subsidiary": [
        *_all(SUBSIDIARY.names),
        Unique("subsidiary_code"),
        Accepted("subsidiary_code", CODES),
        Accepted("industry_type", tuple(row[2] for row in SUBSIDIARIES)),
        Accepted("reporting_currency", ("PHP",)),
    ],
    "ent_customer": [
        *_all(CUSTOMER.names[:6]),
        Unique("customer_key"),
        Accepted("subsidiary_code", CODES),
        Accepted(
            "customer_type",
            ("HIGH_VALUE", "STANDARD", "NEW", "AT_RISK", "B2B", "BORROWER", "TENANT"),
        ),
        Accepted(
            "industry_segment", ("RETAIL", "FREIGHT", "LENDING", "MANUFACTURING", "REAL_ESTATE")
        ),
    ],
    "ent_account": [
        *_all(ACCOUNT.names),
        Unique("account_key"),
        Related("customer_key", "ent_customer", "customer_key"),
        Accepted("subsidiary_code", CODES),
    ],
    "ent_product": [
        *_all(PRODUCT.names),
        Unique("product_key"),
        Accepted("subsidiary_code", CODES),
    ],
    "ent_transaction": [
        *_all(TRANSACTION.names),
        Unique("transaction_key"),
        Related("account_key", "ent_account", "account_key"),
        Related("product_key", "ent_product", "product_key"),
        Accepted("subsidiary_code", CODES),
        HasType("transaction_date", "date"),
        Between("transaction_date", date(2018, 1, 1), date(2030, 12, 31)),
        Between("amount_local", 0, 1000000000),
        Accepted("currency_code", ("PHP", *CURRENCIES)),
        Accepted("gl_account_code", REVENUE_CODES),
        Between("amount_php", 0, 1000000000),
    ],
}

# Columns of each mart that are never NULL.
_MONTH = ("year", "month_num", "month_name")
MART_NOT_NULL: dict[str, Sequence[str]] = {
    "mart_consolidated_pnl": (
        "year", "quarter", "month_name", "subsidiary_code", "subsidiary_name", "industry_type",
        "gl_account_code", "revenue_php", "unique_customers", "transaction_count",
    ),
    "mart_subsidiary_kpi": (
        "subsidiary_code", "subsidiary_name", "industry_type", *_MONTH, "transaction_count",
        "active_customers", "revenue_php",
    ),
    "mart_customer_360": (
        "customer_id_nk", "customer_type", "subsidiary_count", "total_group_revenue_php",
        "first_transaction", "last_transaction", "total_transactions",
    ),
    "mart_intercompany_elimination": (
        "selling_txn_key", "buying_txn_key", "seller_subsidiary", "buyer_subsidiary",
        "shared_counterparty", "transaction_date", "seller_amount_php", "buyer_amount_php",
        "interco_amount_php", "elimination_debit_php", "elimination_credit_php",
        "amount_difference",
    ),
    "mart_freight_ops": (
        *_MONTH, "origin_city", "dest_city", "route", "service_type", "shipment_count",
    ),
    "mart_fx_exposure": (
        *_MONTH, "subsidiary_code", "currency_code", "is_fx_exposed", "transaction_count",
    ),
    "mart_order_fulfillment": (*_MONTH, "plant", "sales_org", "doc_type", "order_count"),
    "mart_loan_portfolio": ("loan_type", "branch_id", "loan_count"),
    "mart_lease_portfolio": ("lease_type", "unit_type", "city", "total_units"),
    "mart_retail_sales": (*_MONTH, "channel", "category", "region", "order_count"),
    "mart_product_performance": (
        *_MONTH, "subsidiary_code", "product_category", "transaction_count",
        "unique_customers", "revenue_php",
    ),
    "mart_cohort_retention": (
        "subsidiary_code", "cohort_month", "cohort_size", "months_since_acquisition",
        "retained_customers", "retention_rate_pct",
    ),
    "mart_gl_account_bridge": (
        *_MONTH, "subsidiary_code", "group_gl_code", "balance_php", "posting_count",
    ),
    "mart_cash_collection": (*_MONTH, "subsidiary_code", "billed_php"),
    "mart_cost_center_spend": (
        *_MONTH, "subsidiary_code", "cost_center", "posting_count", "total_spend_php",
    ),
}

# The marts' other rules.
_MART_OTHER: dict[str, list[Any]] = {
    "mart_consolidated_pnl": [
        Accepted("quarter", (1, 2, 3, 4)), Accepted("subsidiary_code", CODES),
    ],
    "mart_subsidiary_kpi": [Accepted("subsidiary_code", CODES)],
    "mart_customer_360": [Unique("customer_id_nk")],
    "mart_intercompany_elimination": [
        Unique("selling_txn_key"),
        Unique("buying_txn_key"),
        Accepted("seller_subsidiary", CODES),
        Accepted("buyer_subsidiary", CODES),
    ],
    "mart_cohort_retention": [Accepted("subsidiary_code", CODES)],
}

MART_RULES: dict[str, list[Any]] = {
    mart: [*_all(columns), *_MART_OTHER.get(mart, [])]
    for mart, columns in MART_NOT_NULL.items()
}


def of_kind(rules: Mapping[str, Sequence[Any]], kind: type) -> dict[str, list[Any]]:
    """Only the rules of one kind, without the tables that have none."""
    chosen = {t: [r for r in listed if isinstance(r, kind)] for t, listed in rules.items()}
    return {t: listed for t, listed in chosen.items() if listed}


def _close(actual: Column | str, expected: Column, tolerance: str = "0.01") -> Column:
    actual = F.col(actual) if isinstance(actual, str) else actual
    return F.abs(actual.cast("decimal(24,8)") - expected.cast("decimal(24,8)")) <= F.lit(
        tolerance
    ).cast("decimal(24,8)")


def _days_after(later: str, earlier: str, n: Column) -> Column:
    return F.date_diff(F.col(later).cast("date"), F.col(earlier).cast("date")) == n


def reconciliation_rules(as_of: date) -> dict[str, list[Any]]:
    """What the source systems state about the columns of one row."""
    c = F.col
    ordered, delivered = c("order_qty"), c("delivered_qty").try_cast("int")
    discounted = c("unit_price") * c("qty") * (100 - c("discount_pct")) / 100
    payment = (
        c("principal_amount").cast("double") / c("term_months")
        * (1 + c("interest_rate").cast("double") / 100 / 12)
    )
    return {
        "raw_sub_a_sales": [Holds("net_sales", _close("net_sales", discounted))],
        "raw_sub_b_shipments": [
            Holds("fuel_surcharge", _close("fuel_surcharge", c("freight_revenue") * 0.08)),
            Holds(
                "total_revenue",
                _close("total_revenue", c("freight_revenue") + c("fuel_surcharge"), "0"),
            ),
            Holds("delay_days", _days_after("actual_del", "expected_del", c("delay_days"))),
        ],
        "raw_sub_c_loans": [
            Holds("monthly_payment", _close("monthly_payment", payment)),
            Holds(
                "maturity_date",
                _days_after("maturity_date", "origination_date", c("term_months") * 30),
            ),
        ],
        "raw_sub_d_orders": [
            Holds("order_value_php", _close("order_value_php", ordered * c("net_price"), "0")),
            Holds("delivered_qty", (delivered <= ordered) & (delivered * 10 >= ordered * 8 - 10)),
        ],
        "raw_sub_e_leases": [
            Holds("annual_rent_php", _close("annual_rent_php", c("monthly_rent_php") * 12, "0")),
            Holds("security_deposit", _close("security_deposit", c("monthly_rent_php") * 2, "0")),
            Holds("end_date", _days_after("end_date", "start_date", c("term_years") * 365)),
            Holds(
                "status",
                (c("status") == "ACTIVE") == (c("end_date").cast("date") > F.lit(as_of)),
            ),
        ],
    }


# Subsidiaries that may be missing from the consolidated result.
MAY_BE_MISSING = ("SUB_C", "SUB_E")


def missing_subsidiaries(subsidiaries: DataFrame, pnl: DataFrame) -> DataFrame:
    """Subsidiaries without a line in the consolidated result, exempt ones left out."""
    return (
        subsidiaries.join(pnl.select("subsidiary_code").distinct(), "subsidiary_code", "left_anti")
        .filter(~F.col("subsidiary_code").isin(*MAY_BE_MISSING))
        .select("subsidiary_code", "subsidiary_name")
    )


def unbalanced_pairs(pairs: DataFrame) -> DataFrame:
    """Intercompany pairs with a missing leg or amounts that differ, for looking at them."""
    legs = (
        "interco_amount_php", "seller_amount_php", "buyer_amount_php", "elimination_debit_php",
        "elimination_credit_php",
    )
    broken = F.col("amount_difference") >= F.lit("0.01").cast("decimal(3,2)")
    for leg in legs:
        broken = broken | F.col(leg).isNull()
    return pairs.filter(broken)


def unbalanced_pair_counts(facts: DataFrame, mapping: DataFrame) -> DataFrame:
    """How many such pairs each seller and buyer have, without building the pairs.

    Amounts have whole centavos, so a pair is balanced exactly when both amounts
    are present and equal. Per customer and day the number of pairs of two
    subsidiaries is the product of their row counts; the balanced ones follow in
    the same way with the amount as a further key.
    """
    postings = interco_postings(facts, mapping)
    keys = ["customer_id_nk", "transaction_date"]
    matched = postings.filter(F.col("customer_id_nk").isNotNull())

    def pair_counts(rows: DataFrame, by: list[str], out: str) -> DataFrame:
        per_key = rows.groupBy(*by).agg(
            *[F.count_if(F.col("subsidiary_code") == c).cast("decimal(19,0)").alias(c) for c in CODES]
        )
        couples = list(combinations(CODES, 2))
        sums = per_key.agg(*[F.sum(F.col(a) * F.col(b)).alias(a + b) for a, b in couples])
        lines = F.array(
            *[
                F.struct(
                    F.lit(a).alias("seller_subsidiary"),
                    F.lit(b).alias("buyer_subsidiary"),
                    F.coalesce(F.col(a + b), F.lit(0)).cast("decimal(38,0)").alias(out),
                )
                for a, b in couples
            ]
        )
        return sums.select(F.explode(lines).alias("line")).select("line.*")

    whole = pair_counts(matched, keys, "pairs")
    valued = matched.filter(F.col("amount_php").isNotNull())
    equal = pair_counts(valued, [*keys, "amount_php"], "balanced")
    return whole.join(equal, ["seller_subsidiary", "buyer_subsidiary"]).select(
        "seller_subsidiary",
        "buyer_subsidiary",
        F.col("pairs").cast("bigint").alias("pairs"),
        (F.col("pairs") - F.col("balanced")).cast("bigint").alias("failing_rows"),
    )
