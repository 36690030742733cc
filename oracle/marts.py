"""SQL of the marts."""

from __future__ import annotations

from .base import money, pct, query, ratio

PERIOD = "year, month_num, month_name"


def growth(value: str, per: str, order: str) -> str:
    lag = f"lag({value}) OVER (PARTITION BY {per} ORDER BY {order})"
    return pct(f"({value} - {lag})", lag)


def share(value: str, per: str) -> str:
    return pct(value, f"sum({value}) OVER (PARTITION BY {per})")


def avg(expr: str, digits: int) -> str:
    return ratio(f"sum({expr})", f"count({expr})", digits)


def cnt(cond: str) -> str:
    return f"count(CASE WHEN {cond} THEN 1 END)"


def sum_if(cond: str, expr: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN {expr} ELSE 0 END) AS DECIMAL(38,2))"


FREIGHT = f"""
SELECT {PERIOD}, origin_city, dest_city, origin_city || ' → ' || dest_city AS route, service_type,
       count(*) AS shipment_count, {money('weight_kg')} AS total_weight_kg,
       {money('volume_cbm')} AS total_volume_cbm, {money('freight_revenue')} AS freight_revenue_php,
       {money('fuel_surcharge')} AS fuel_surcharge_php, {money('amount_local')} AS total_revenue_php,
       {ratio('sum(amount_local)', 'sum(weight_kg)', 4)} AS revenue_per_kg,
       {cnt('delay_days = 0')} AS on_time_count,
       {pct(cnt('delay_days = 0'), 'count(*)')} AS otd_rate_pct,
       {avg('delay_days', 2)} AS avg_delay_days, max(delay_days) AS max_delay_days,
       {cnt('delay_days > 3')} AS severely_delayed_count
FROM stg_b JOIN cal ON transaction_date = date_key GROUP BY ALL"""

SPEND_TOTALS = f"""
spend AS (
  SELECT {PERIOD}, f.subsidiary_code, cost_center, product_category, count(*) AS posting_count,
         {money('amount_php')} AS total_spend_php, {avg('amount_php', 2)} AS avg_posting_php
  FROM fact f JOIN prod p ON f.product_key = p.product_key AND f.subsidiary_code = p.subsidiary_code
  JOIN cal ON transaction_date = date_key
  WHERE gl_account_code NOT LIKE '%REVENUE%' AND gl_account_code NOT LIKE '%INCOME%' GROUP BY ALL
)"""

SPEND = f"""
SELECT *, {growth('total_spend_php', 'subsidiary_code, cost_center, product_category', 'year, month_num')}
         AS mom_spend_change_pct,
       {share('total_spend_php', 'subsidiary_code, year, month_num')} AS subsidiary_spend_share_pct,
       {share('total_spend_php', 'year, month_num')} AS group_spend_share_pct FROM spend"""

PNL = f"""
SELECT CAST(year(transaction_date) AS INTEGER) AS year, CAST(quarter(transaction_date) AS INTEGER) AS quarter,
       strftime(transaction_date, '%B') AS month_name, subsidiary_code, subsidiary_name, industry_type,
       gl_account_code, {money('amount_php')} AS revenue_php,
       count(DISTINCT customer_id_nk) AS unique_customers, count(*) AS transaction_count,
       {ratio('sum(amount_php)', 'count(DISTINCT customer_id_nk)', 2)} AS revenue_per_customer
FROM fact JOIN subs USING (subsidiary_code)
WHERE gl_account_code IN ('RETAIL_REVENUE','FREIGHT_REVENUE','MANUFACTURING_REVENUE',
                          'INTEREST_INCOME','RENTAL_INCOME') OR gl_account_code LIKE '%REVENUE%'
GROUP BY ALL"""

INTERCO = """
ic AS MATERIALIZED (
  SELECT transaction_key, f.subsidiary_code, customer_id_nk, transaction_date, f.gl_account_code, amount_php FROM fact f JOIN gl ON f.gl_account_code = gl.subsidiary_gl_code
    AND f.subsidiary_code = gl.subsidiary_code WHERE gl_sub_category = 'INTERCOMPANY_REVENUE'
),
pairs AS (
  SELECT s.transaction_key AS selling_txn_key, b.transaction_key AS buying_txn_key,
         s.subsidiary_code AS seller_subsidiary, b.subsidiary_code AS buyer_subsidiary,
         s.customer_id_nk AS shared_counterparty, s.transaction_date,
         s.gl_account_code AS seller_gl_code, b.gl_account_code AS buyer_gl_code,
         s.amount_php AS seller_amount_php, b.amount_php AS buyer_amount_php,
         s.amount_php AS interco_amount_php, CAST(-s.amount_php AS DECIMAL(18,2)) AS elimination_debit_php,
         b.amount_php AS elimination_credit_php,
         CAST(abs(s.amount_php - b.amount_php) AS DECIMAL(19,2)) AS amount_difference
  FROM ic s JOIN ic b ON s.customer_id_nk = b.customer_id_nk
    AND s.transaction_date = b.transaction_date AND s.subsidiary_code < b.subsidiary_code
)"""


def collected(view: str, code: str, amount: str, lag: str, grace: int) -> str:
    return f"""
  SELECT '{code}' AS subsidiary_code, CAST(date_trunc('month', transaction_date) AS DATE) AS m,
         {money(amount)} AS billed_php, {avg(lag, 1)} AS avg_dso_days,
         {sum_if(f'{lag} = 0', amount)} AS collected_on_time_php,
         {sum_if(f'{lag} BETWEEN 1 AND {grace}', amount)} AS collected_1_7d_php,
         {sum_if(f'{lag} > {grace}', amount)} AS collected_7d_plus_php
  FROM {view} GROUP BY ALL"""


BILLED = f"""
billed AS (
  {collected('stg_a', 'SUB_A', 'amount_local', '0', 7)}
  UNION ALL {collected('stg_b', 'SUB_B', 'amount_local', 'delay_days', 7)}
  UNION ALL {collected("stg_c WHERE loan_status <> 'CLOSED'", 'SUB_C', 'monthly_payment', 'days_past_due', 30)}
)"""

MONTHLY_KPI = f"""
kpi AS (
  SELECT subsidiary_code, subsidiary_name, industry_type, {PERIOD}, count(*) AS transaction_count,
         count(DISTINCT customer_id_nk) AS active_customers, {money('amount_php')} AS revenue_php,
         {avg('amount_php', 6)} AS avg_transaction_php
  FROM fact JOIN subs USING (subsidiary_code) JOIN cal ON transaction_date = date_key
  WHERE gl_account_code LIKE '%REVENUE%' GROUP BY ALL
)"""

EXPOSURE = f"""
expo AS (
  SELECT {PERIOD}, subsidiary_code, currency_code, currency_code <> 'PHP' AS is_fx_exposed,
         count(*) AS transaction_count, {money('amount_local')} AS total_local_amount,
         {money('amount_php')} AS total_php_equivalent,
         CAST(round({money('amount_php')} * CAST(0.05 AS DECIMAL(3,2)), 2) AS DECIMAL(38,2))
           AS fx_sensitivity_5pct_php,
         {avg('usd_php_rate', 6)} AS avg_fx_rate
  FROM fact JOIN cal ON transaction_date = date_key
  LEFT JOIN fx ON transaction_date = rate_date AND currency_code = from_currency GROUP BY ALL
)"""

PRODUCT = f"""
perf AS (
  SELECT {PERIOD}, f.subsidiary_code, product_category, cost_center,
         count(DISTINCT transaction_key) AS transaction_count,
         count(DISTINCT customer_id_nk) AS unique_customers, {money('amount_php')} AS revenue_php
  FROM fact f JOIN prod p ON f.product_key = p.product_key AND f.subsidiary_code = p.subsidiary_code
  JOIN cal ON transaction_date = date_key WHERE gl_account_code LIKE '%REVENUE%' GROUP BY ALL
)"""

BRIDGE = f"""
bridge AS (
  SELECT {PERIOD}, f.subsidiary_code, group_gl_code, group_gl_name, gl_category, gl_sub_category,
         f.gl_account_code AS subsidiary_gl_code, {money('amount_php')} AS balance_php,
         count(*) AS posting_count
  FROM fact f JOIN gl ON f.gl_account_code = gl.subsidiary_gl_code AND f.subsidiary_code = gl.subsidiary_code
  JOIN cal ON transaction_date = date_key GROUP BY ALL
)"""

RETAIL = f"""
retail AS (
  SELECT {PERIOD}, channel, category, region, count(*) AS order_count,
         CAST(sum(qty) AS BIGINT) AS units_sold, count(DISTINCT customer_id_nk) AS unique_customers,
         {money('amount_local')} AS net_sales_php, {money('unit_price * qty')} AS gross_sales_php,
         {money('unit_price * qty - amount_local')} AS discount_amount_php,
         {avg('discount_pct', 2)} AS avg_discount_pct,
         {ratio('sum(amount_local)', 'count(DISTINCT customer_id_nk)', 2)} AS revenue_per_customer,
         {ratio('sum(amount_local)', 'count(*)', 2)} AS avg_order_value
  FROM stg_a JOIN cal ON transaction_date = date_key GROUP BY ALL
)"""

COHORT = f"""
coh AS (
  SELECT customer_id_nk, subsidiary_code, CAST(date_trunc('month', acquire_date) AS DATE) AS cohort_month
  FROM cust WHERE acquire_date IS NOT NULL
),
siz AS (
  SELECT subsidiary_code, cohort_month, count(DISTINCT customer_id_nk) AS cohort_size FROM coh GROUP BY ALL
),
act AS (
  SELECT DISTINCT coh.customer_id_nk, coh.subsidiary_code, cohort_month,
         CAST(datediff('month', cohort_month, CAST(date_trunc('month', transaction_date) AS DATE)) AS INTEGER)
           AS months_since_acquisition
  FROM coh JOIN fact USING (customer_id_nk, subsidiary_code) WHERE transaction_date >= cohort_month
)"""

ACTIVE = "status = 'ACTIVE'"
ENDING = "status = 'ACTIVE' AND datediff('day', DATE '2000-01-01', end_date) <= 90"
RISK = "loan_status IN ('90DPD','NPL')"

MARTS = {
    "mart_consolidated_pnl": query(PNL),
    "mart_intercompany_elimination": query("SELECT * FROM pairs", INTERCO),
    "mart_customer_360": query(f"""
SELECT customer_id_nk, customer_type, count(DISTINCT subsidiary_code) AS subsidiary_count,
       string_agg(DISTINCT subsidiary_code, ',' ORDER BY subsidiary_code) AS subsidiaries,
       {money('amount_php')} AS total_group_revenue_php, min(transaction_date) AS first_transaction,
       max(transaction_date) AS last_transaction, count(*) AS total_transactions
FROM cust JOIN fact USING (customer_id_nk, subsidiary_code) GROUP BY 1, 2"""),
    "mart_subsidiary_kpi": query(f"""
SELECT *, {growth('revenue_php', 'subsidiary_code', 'year, month_num')} AS mom_revenue_growth_pct,
       {share('revenue_php', 'year, month_num')} AS group_revenue_share_pct FROM kpi""", MONTHLY_KPI),
    "mart_fx_exposure": query(f"""
SELECT *, {share('total_php_equivalent', 'year, month_num')} AS currency_revenue_share_pct
FROM expo ORDER BY year, month_num, subsidiary_code, currency_code""", EXPOSURE),
    "mart_product_performance": query(f"""
SELECT *, {ratio('revenue_php', 'transaction_count', 2)} AS avg_revenue_per_txn,
       CAST(rank() OVER (PARTITION BY subsidiary_code, year, month_num
            ORDER BY revenue_php DESC NULLS FIRST) AS INTEGER) AS category_revenue_rank,
       {share('revenue_php', 'subsidiary_code, year, month_num')} AS subsidiary_category_share_pct,
       {share('revenue_php', 'year, month_num')} AS group_category_share_pct
FROM perf""", PRODUCT),
    "mart_gl_account_bridge": query(f"""
SELECT *, {share('balance_php', 'group_gl_code, year, month_num')} AS subsidiary_gl_share_pct
FROM bridge""", BRIDGE),
    "mart_cost_center_spend": query(SPEND, SPEND_TOTALS),
    "mart_retail_sales": query(f"""
SELECT *, {share('net_sales_php', 'year, month_num')} AS channel_revenue_share_pct FROM retail""", RETAIL),
    "mart_cohort_retention": query(f"""
SELECT subsidiary_code, cohort_month, cohort_size, months_since_acquisition,
       count(DISTINCT customer_id_nk) AS retained_customers,
       {pct('count(DISTINCT customer_id_nk)', 'cohort_size')} AS retention_rate_pct
FROM act JOIN siz USING (subsidiary_code, cohort_month)
GROUP BY subsidiary_code, cohort_month, cohort_size, months_since_acquisition""", COHORT),
    "mart_freight_ops": query(FREIGHT),
    "mart_cash_collection": query(f"""
SELECT {PERIOD}, subsidiary_code, billed_php, collected_on_time_php, collected_1_7d_php,
       collected_7d_plus_php, avg_dso_days,
       {pct('collected_on_time_php', 'billed_php')} AS on_time_collection_rate_pct,
       CAST(billed_php - collected_on_time_php - collected_1_7d_php AS DECIMAL(38,2)) AS est_outstanding_php
FROM billed JOIN cal ON m = date_key""", BILLED),
    "mart_loan_portfolio": query(f"""
SELECT loan_type, branch_id, count(*) AS loan_count, {money('principal_amount')} AS total_principal_php,
       {money('outstanding_balance')} AS total_outstanding_php,
       {avg('interest_rate', 2)} AS avg_interest_rate_pct, {avg('term_months', 0)} AS avg_term_months,
       {cnt("loan_status = 'CURRENT'")} AS current_count,
       {cnt("loan_status = 'GRACE_PERIOD'")} AS grace_period_count,
       {cnt("loan_status = '30DPD'")} AS dpd_30_count, {cnt("loan_status = '60DPD'")} AS dpd_60_count,
       {cnt("loan_status = '90DPD'")} AS dpd_90_count, {cnt("loan_status = 'NPL'")} AS npl_count,
       {cnt("loan_status = 'RESTRUCTURED'")} AS restructured_count,
       {cnt("loan_status = 'CHARGED_OFF'")} AS charged_off_count,
       {pct(cnt("loan_status = 'NPL'"), 'count(*)')} AS npl_rate_pct,
       {sum_if(RISK, 'outstanding_balance')} AS balance_at_risk_php,
       {pct(sum_if(RISK, 'outstanding_balance'), 'sum(outstanding_balance)')} AS balance_at_risk_pct
FROM stg_c WHERE loan_status <> 'CLOSED' GROUP BY ALL"""),
    "mart_order_fulfillment": query(f"""
SELECT {PERIOD}, plant, sales_org, doc_type, count(*) AS order_count,
       CAST(sum(order_qty) AS BIGINT) AS total_order_qty,
       CAST(sum(delivered_qty) AS BIGINT) AS total_delivered_qty,
       {money('amount_local')} AS order_value_php,
       {ratio('sum(amount_local)', 'count(*)', 2)} AS avg_order_value_php,
       {pct('sum(delivered_qty)', 'sum(order_qty)')} AS fill_rate_pct,
       {cnt("status = 'DELIVERED'")} AS delivered_count, {cnt("status = 'BILLED'")} AS billed_count,
       {cnt("status = 'OPEN'")} AS open_count, {cnt("status = 'CANCELLED'")} AS cancelled_count,
       {pct(cnt("status = 'CANCELLED'"), 'count(*)')} AS cancellation_rate_pct,
       {avg("datediff('day', transaction_date, confirmed_del)", 1)} AS avg_lead_time_days
FROM stg_d JOIN cal ON transaction_date = date_key GROUP BY ALL"""),
    "mart_lease_portfolio": query(f"""
SELECT lease_type, unit_type, city, count(*) AS total_units, {cnt(ACTIVE)} AS occupied_units,
       {cnt("status = 'EXPIRED'")} AS vacant_units, {pct(cnt(ACTIVE), 'count(*)')} AS occupancy_rate_pct,
       {money('area_sqm')} AS total_area_sqm, {sum_if(ACTIVE, 'area_sqm')} AS occupied_area_sqm,
       {sum_if(ACTIVE, 'monthly_rent_php')} AS monthly_rent_roll_php,
       {sum_if(ACTIVE, 'annual_rent_php')} AS arr_php, {money('security_deposit')} AS total_deposits_held_php,
       {ratio(f"sum(CASE WHEN {ACTIVE} THEN rent_escalation_pct * monthly_rent_php ELSE 0 END)", sum_if(ACTIVE, 'monthly_rent_php'), 2)}
         AS wtd_avg_escalation_pct,
       {cnt(ENDING)} AS expiring_90d_count, {sum_if(ENDING, 'monthly_rent_php')} AS expiring_90d_monthly_rent_php
FROM stg_e GROUP BY ALL"""),
}
