"""Column layouts: the six landing tables, the canonical fact shape, the seeds."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(15, 2)
MONEY_SUM = "decimal(38,2)"


def _layout(*parts: str) -> T.StructType:
    """Columns written as "name type", comma and space between them."""
    schema = T.StructType()
    for column in ", ".join(parts).split(", "):
        name, kind = column.split(" ")
        schema = schema.add(name, kind)
    return schema


# Landing columns in file order, with their types.
BRONZE: dict[str, T.StructType] = {
    "raw_sub_a_sales": _layout(
        "order_id string, order_date timestamp_ntz, customer_id string, product_sku string",
        "channel string, category string, region string, qty integer, unit_price decimal(12,2)",
        "discount_pct decimal(5,2), net_sales decimal(15,2), currency string",
        "updated_at timestamp_ntz",
    ),
    "raw_sub_a_customers": _layout(
        "customer_id string, full_name string, email string, phone string, region string",
        "segment string, join_date timestamp_ntz, is_active boolean",
    ),
    "raw_sub_b_shipments": _layout(
        "shipment_id string, client_id string, origin_city string, dest_city string",
        "service_type string, ship_date timestamp_ntz, expected_del timestamp_ntz",
        "actual_del timestamp_ntz, delay_days integer, weight_kg decimal(10,2)",
        "volume_cbm decimal(10,2), freight_revenue decimal(15,2)",
        "fuel_surcharge decimal(15,2), total_revenue decimal(15,2), currency string",
        "modified_ts timestamp_ntz",
    ),
    "raw_sub_c_loans": _layout(
        "loan_id string, borrower_id string, loan_type string",
        "origination_date timestamp_ntz, maturity_date timestamp_ntz, term_months integer",
        "principal_amount decimal(15,2), interest_rate decimal(5,2)",
        "outstanding_balance decimal(15,2), monthly_payment decimal(15,2)",
        "loan_status string, days_past_due integer, branch_id string, currency string",
        "last_updated timestamp_ntz",
    ),
    "raw_sub_d_orders": _layout(
        "order_num string, order_item string, doc_type string, sales_org string",
        "customer_id string, material_id string, plant string, order_date timestamp_ntz",
        "requested_del timestamp_ntz, confirmed_del timestamp_ntz, order_qty integer",
        "delivered_qty string, net_price decimal(12,2), order_value_php decimal(15,2)",
        "currency string, status string, change_date timestamp_ntz",
    ),
    "raw_sub_e_leases": _layout(
        "contract_id string, property_id string, tenant_id string, unit_type string",
        "lease_type string, area_sqm decimal(10,2), start_date timestamp_ntz",
        "end_date timestamp_ntz, term_years integer, monthly_rent_php decimal(15,2)",
        "annual_rent_php decimal(15,2), security_deposit decimal(15,2)",
        "rent_escalation_pct decimal(5,2), status string, city string",
    ),
}

AUDIT = _layout("_subsidiary_code string, _loaded_at timestamp_ntz")

# A source that books to several ledger codes may carry the code in this extra
# column; without it every row takes its subsidiary's revenue code.
LEDGER_CODE = "gl_account_code"

CANONICAL = _layout(
    "transaction_nk string, subsidiary_code string, customer_id_nk string",
    "transaction_date date, amount_local decimal(15,2), currency_code string",
    "gl_account_code string, _loaded_at timestamp_ntz",
)

CUSTOMER = _layout(
    "customer_key string, customer_id_nk string, subsidiary_code string",
    "customer_type string, industry_segment string, acquire_date date, full_name string",
    "email string, customer_region string, is_active boolean",
)

PRODUCT = _layout(
    "product_key string, product_id_nk string, subsidiary_code string",
    "product_category string, product_class string, cost_center string",
    "_loaded_at timestamp_ntz",
)

ACCOUNT = _layout(
    "account_key string, account_id_nk string, customer_key string",
    "subsidiary_code string, account_type string, open_date date",
)

TRANSACTION = _layout(
    "transaction_key string, account_key string, product_key string",
    "transaction_nk string, subsidiary_code string, customer_id_nk string",
    "transaction_date date, amount_local decimal(15,2), currency_code string",
    "gl_account_code string, _loaded_at timestamp_ntz, amount_php decimal(18,2)",
)

FX_RATE = _layout(
    "rate_date date, from_currency string, to_currency string, rate decimal(18,8)",
    "usd_php_rate decimal(18,6)",
)

GL_MAPPING = _layout(
    "subsidiary_code string, subsidiary_gl_code string, group_gl_code string",
    "group_gl_name string, gl_category string, gl_sub_category string",
)

SUBSIDIARY = _layout(
    "subsidiary_code string, subsidiary_name string, industry_type string",
    "reporting_currency string",
)

INGESTION_CONFIG = _layout(
    "subsidiary_code string, source_schema string, source_table string",
    "target_schema string, target_table string, load_strategy string",
    "incremental_column string, primary_key_column string, active boolean",
    "last_loaded_at timestamp_ntz",
)
