"""SQL of the calendar, staging, entity and loading queries."""

from __future__ import annotations

from .base import query
from .marts import FREIGHT, SPEND, SPEND_TOTALS

FACT_COLUMNS = (
    "transaction_key, account_key, product_key, transaction_nk, subsidiary_code, customer_id_nk, "
    "transaction_date, amount_local, currency_code, gl_account_code, _loaded_at, amount_php"
)

COUNTED = """
times AS (
  SELECT 'SUB_A' AS subsidiary_code, 'raw_sub_a_sales' AS target_table, updated_at AS loaded FROM raw_a
  UNION ALL SELECT 'SUB_A', 'raw_sub_a_customers', CAST(NULL AS TIMESTAMP) FROM raw_a_cust
  UNION ALL SELECT 'SUB_B', 'raw_sub_b_shipments', modified_ts FROM raw_b
  UNION ALL SELECT 'SUB_C', 'raw_sub_c_loans', last_updated FROM raw_c
  UNION ALL SELECT 'SUB_D', 'raw_sub_d_orders', change_date FROM raw_d
  UNION ALL SELECT 'SUB_E', 'raw_sub_e_leases', CAST(NULL AS TIMESTAMP) FROM raw_e
),
cfg(subsidiary_code, source_schema, source_table, target_schema, target_table, load_strategy,
    incremental_column, primary_key_column, active, last_loaded_at) AS (
  VALUES
  ('SUB_A','sub_a_pos','sales_transactions','bronze','raw_sub_a_sales','INCREMENTAL','updated_at','order_id',TRUE,TIMESTAMP '1998-06-30'),
  ('SUB_A','sub_a_pos','customers','bronze','raw_sub_a_customers','FULL',NULL,'customer_id',TRUE,NULL),
  ('SUB_B','sub_b_tms','shipments','bronze','raw_sub_b_shipments','INCREMENTAL','modified_ts','shipment_id',TRUE,NULL),
  ('SUB_C','sub_c_core','loan_accounts','bronze','raw_sub_c_loans','INCREMENTAL','last_updated','loan_id',TRUE,TIMESTAMP '2000-01-01'),
  ('SUB_D','sub_d_sap','sales_orders','bronze','raw_sub_d_orders','INCREMENTAL','change_date','order_num',TRUE,TIMESTAMP '1999-01-01'),
  ('SUB_E','sub_e_pms','lease_contracts','bronze','raw_sub_e_leases','FULL',NULL,'contract_id',FALSE,NULL)
)"""

LATEST_PRODUCT = """
  QUALIFY row_number() OVER (PARTITION BY subsidiary_code, product_id_nk
    ORDER BY _loaded_at DESC, product_category DESC, cost_center DESC) = 1"""


def _summary(table: str, view: str, amount: str, day: str) -> str:
    return (
        f"SELECT '{table[4:9].upper()}' AS _subsidiary_code, '{table}' AS table_name, "
        f"count(*) AS row_count, CAST(sum({amount}) AS DECIMAL(38,2)) AS total, "
        f"min({day}) AS first_day, max({day}) AS last_day FROM {view}"
    )


LOADS = {
    "dim_date": """
WITH days AS (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem),
bounds AS (SELECT date_trunc('year', min(d)) AS a, date_trunc('year', max(d)) + INTERVAL 1 YEAR AS b FROM days),
spine AS (SELECT unnest(range(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM bounds)
SELECT CAST(d AS DATE) AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month_num, strftime(d, '%b') AS month_name,
       CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
       strftime(d, '%a') AS day_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
       dayofweek(d) IN (0, 6) AS is_weekend, strftime(d, '%Y-%m') AS year_month,
       year(d) || '-Q' || quarter(d) AS year_quarter
FROM spine""",
    "fx_rates_prepared": query("SELECT * FROM fx"),
    "gl_mapping_usage": query("""
SELECT gl.*, count(f.transaction_key) AS posting_count FROM gl LEFT JOIN fact f
  ON f.subsidiary_code = gl.subsidiary_code AND f.gl_account_code = gl.subsidiary_gl_code GROUP BY ALL"""),
    "stg_retail": query("SELECT * FROM stg_a"),
    "stg_freight": query("SELECT * FROM stg_b"),
    "stg_loans": query("SELECT * FROM stg_c"),
    "stg_orders": query("SELECT * FROM stg_d"),
    "stg_leases": query("SELECT * FROM stg_e"),
    "ent_subsidiary_usage": query("""
SELECT subs.*, count(*) AS transaction_count, min(transaction_date) AS first_transaction,
       max(transaction_date) AS last_transaction FROM subs LEFT JOIN fact USING (subsidiary_code) GROUP BY ALL"""),
    "ent_customer": query("SELECT * FROM cust"),
    "ent_account": query("SELECT * FROM acct"),
    "ent_product": query("SELECT * FROM prod"),
    "ent_transaction": query(f"SELECT {FACT_COLUMNS} FROM fact"),
    "ingest_new_row_counts": query("""
SELECT subsidiary_code, target_table, load_strategy,
       count(t.target_table) FILTER (WHERE load_strategy <> 'INCREMENTAL' OR incremental_column IS NULL
         OR last_loaded_at IS NULL OR loaded > last_loaded_at) AS new_rows
FROM cfg LEFT JOIN times t USING (subsidiary_code, target_table) WHERE active
GROUP BY subsidiary_code, target_table, load_strategy""", COUNTED),
    "ingest_watermarks": query("""
SELECT cfg.* REPLACE (CASE WHEN NOT active THEN last_loaded_at
  WHEN load_strategy = 'INCREMENTAL' THEN greatest(last_loaded_at, seen)
  ELSE TIMESTAMP '2002-01-02' END AS last_loaded_at)
FROM cfg LEFT JOIN (SELECT subsidiary_code, target_table, max(loaded) AS seen FROM times GROUP BY ALL) USING (subsidiary_code, target_table)""", COUNTED),
    "config_merge": query("""
SELECT * FROM early UNION ALL
SELECT * FROM prod p WHERE NOT EXISTS (SELECT 1 FROM early e WHERE e.product_key = p.product_key
  AND e.subsidiary_code = p.subsidiary_code)""", f"""
early AS (
  SELECT md5(subsidiary_code || product_id_nk) AS product_key, product_id_nk, subsidiary_code,
         product_category, product_class, cost_center, _loaded_at
  FROM (SELECT * FROM prod0 WHERE _loaded_at <= TIMESTAMP '1995-03-31'){LATEST_PRODUCT}
)"""),
    "incremental_filter_by_source": query("""
SELECT transaction_key, subsidiary_code, amount_php, _loaded_at FROM fact f
WHERE _loaded_at > coalesce((SELECT max(_loaded_at) FROM fact t WHERE t.subsidiary_code = f.subsidiary_code
  AND t._loaded_at <= CASE t.subsidiary_code WHEN 'SUB_A' THEN TIMESTAMP '1998-06-30'
    WHEN 'SUB_B' THEN TIMESTAMP '1997-12-31' WHEN 'SUB_C' THEN TIMESTAMP '1999-03-31'
    WHEN 'SUB_E' THEN TIMESTAMP '2000-12-31' END), TIMESTAMP '1900-01-01')"""),
    "incremental_filter_global": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
WHERE l_shipdate > (SELECT coalesce(max(l_shipdate), TIMESTAMP '1900-01-01') FROM lineitem
                    WHERE l_shipdate <= TIMESTAMP '1998-06-30')""",
    "incremental_upsert": query("""
SELECT * FROM old WHERE transaction_nk NOT IN (SELECT transaction_nk FROM batch)
UNION ALL SELECT * FROM batch
QUALIFY row_number() OVER (PARTITION BY transaction_nk ORDER BY _loaded_at DESC, customer_id_nk DESC,
  transaction_date DESC, amount_local DESC) = 1""", """
sales AS (SELECT transaction_nk, customer_id_nk, transaction_date, amount_local, _loaded_at FROM stg_a),
old AS (
  SELECT * FROM sales WHERE _loaded_at <= TIMESTAMP '1998-06-30'
  QUALIFY row_number() OVER (PARTITION BY transaction_nk ORDER BY _loaded_at DESC, customer_id_nk DESC,
    transaction_date DESC, amount_local DESC) = 1
),
batch AS (
  SELECT * FROM sales WHERE _loaded_at > TIMESTAMP '1998-06-30'
  UNION ALL
  SELECT transaction_nk, customer_id_nk, transaction_date, CAST(amount_local + 100 AS DECIMAL(15,2)),
         TIMESTAMP '1998-07-01'
  FROM sales WHERE _loaded_at BETWEEN TIMESTAMP '1998-04-01' AND TIMESTAMP '1998-06-30'
)"""),
    "incremental_upsert_composite": """
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""",
    "schema_sync_all": """
SELECT o_orderkey, o_custkey, o_orderdate,
       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN NULL
            WHEN o_totalprice >= 250000 THEN 'HIGH' ELSE 'LOW' END AS price_band FROM orders""",
    "schema_append_new": """
SELECT o_orderkey, o_custkey, o_orderdate,
       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN NULL
            WHEN o_totalprice >= 250000 THEN 'HIGH' ELSE 'LOW' END AS price_band FROM orders""",
    "touched_period_refresh": query(FREIGHT),
    "touched_period_spend": query(SPEND, SPEND_TOTALS),
    "stream_available_now_upsert": """
SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type
  ORDER BY ts DESC, event_id DESC) = 1""",
    "stream_two_loads_upsert": """
SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type
  ORDER BY ts DESC, event_id DESC) = 1""",
    "source_freshness": query("""
SELECT target_table, last_loaded, age_seconds,
       CASE WHEN last_loaded IS NULL OR age_seconds > 176400 THEN 'error'
            WHEN age_seconds > 90000 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT target_table, max(loaded) AS last_loaded,
             datediff('second', max(loaded), TIMESTAMP '2001-11-05 02:00:00') AS age_seconds
      FROM times GROUP BY 1)""", COUNTED),
    "csv_round_trip": query("""
SELECT order_id, order_date, customer_id, product_sku, channel, category, region, qty, unit_price,
       discount_pct, net_sales, currency, updated_at, 'SUB_A' AS _subsidiary_code FROM raw_a"""),
    "bronze_load": query(" UNION ALL ".join([
        _summary("raw_sub_a_sales", "raw_a", "net_sales", "order_date"),
        _summary("raw_sub_a_customers", "raw_a_cust", "CAST(is_active AS INTEGER)", "join_date"),
        _summary("raw_sub_b_shipments", "raw_b", "total_revenue", "ship_date"),
        _summary("raw_sub_c_loans", "raw_c", "monthly_payment", "origination_date"),
        _summary("raw_sub_d_orders", "raw_d", "order_value_php", "order_date"),
        _summary("raw_sub_e_leases", "raw_e", "annual_rent_php", "start_date"),
    ])),
}
