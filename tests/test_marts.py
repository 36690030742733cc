"""Edge cases of the marts on a few rows each."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from groupledger.operators.calendar import calendar
from groupledger.operators.joins import hot_key_join, ordered_pairs
from groupledger.plans import marts_business, marts_group
from groupledger.plans.quality_rules import unbalanced_pair_counts, unbalanced_pairs
from groupledger.sources.reference_rows import gl_mapping, subsidiaries

from .conftest import as_list, as_set, day

FACT = (
    "transaction_key string, product_key string, subsidiary_code string, customer_id_nk string, "
    "transaction_date date, gl_account_code string, amount_php decimal(18,2)"
)


@pytest.fixture(scope="module")
def cal(spark):
    return calendar(spark, day("2024-01-01"), day("2025-01-01"))


@pytest.fixture
def facts(rows):
    def make(*data):
        return rows(FACT, *[
            (f"t{i}", p, s, c, day(d), gl, None if a is None else Decimal(a))
            for i, (p, s, c, d, gl, a) in enumerate(data)
        ])

    return make


def sale(day_, amount, product="p1", customer="c1"):
    return (product, "SUB_A", customer, day_, "RETAIL_REVENUE", amount)


def test_growth_is_against_the_previous_existing_month(spark, facts, cal):
    df = facts(sale("2024-01-05", "100.00"), sale("2024-03-05", "150.00"))
    got = marts_group.subsidiary_kpi(df, subsidiaries(spark), cal, 366)
    assert as_set(got.select("month_num", "mom_revenue_growth_pct")) == {(1, None), (3, 50.0)}


def test_growth_from_zero_is_null(spark, facts, cal):
    df = facts(sale("2024-01-05", "0.00"), sale("2024-02-05", "150.00"))
    got = marts_group.subsidiary_kpi(df, subsidiaries(spark), cal, 366)
    assert as_set(got.select("month_num", "mom_revenue_growth_pct")) == {(1, None), (2, None)}


def test_rank_ties_and_null_first(rows, facts, cal):
    df = facts(sale("2024-01-05", "10.00", "p1"), sale("2024-01-06", "10.00", "p2"),
               sale("2024-01-07", None, "p3"), sale("2024-01-08", "5.00", "p4"))
    products = rows(
        "product_key string, subsidiary_code string, product_category string, cost_center string",
        *[(f"p{i}", "SUB_A", f"k{i}", "cc") for i in range(1, 5)])
    got = marts_group.product_performance(df, products, cal, 366)
    assert as_set(got.select("product_category", "category_revenue_rank")) == {
        ("k3", 1), ("k1", 2), ("k2", 2), ("k4", 4)}


def test_spend_leaves_revenue_and_income_out(rows, facts, cal):
    df = facts(
        ("p1", "SUB_A", "c", "2024-01-01", "RETAIL_COGS", "4.00"),
        ("p1", "SUB_A", "c", "2024-01-02", "RETAIL_COGS", None),
        ("p1", "SUB_A", "c", "2024-01-02", "RETAIL_REVENUE", "9.00"),
        ("p1", "SUB_A", "c", "2024-01-02", "INTEREST_INCOME", "9.00"),
        ("p1", "SUB_A", "c", "2024-01-02", None, "9.00"),
    )
    products = rows(
        "product_key string, subsidiary_code string, product_category string, cost_center string",
        ("p1", "SUB_A", "k", "cc"))
    got = marts_group.cost_center_spend(df, products, cal, 366)
    assert as_set(got.select("posting_count", "total_spend_php", "avg_posting_php")) == {
        (2, Decimal("4.00"), 4.0)}


def test_cohort_counts_activity_from_the_first_of_the_month(rows, facts):
    customers = rows(
        "customer_id_nk string, subsidiary_code string, acquire_date date",
        ("c1", "SUB_A", day("2024-01-20")), ("c2", "SUB_A", day("2024-01-25")),
        ("c3", "SUB_A", None))
    df = facts(sale("2024-01-01", "1.00"), sale("2023-12-31", "1.00"), sale("2024-03-01", "1.00"),
               sale("2024-01-02", "1.00", customer="c3"))
    got = marts_group.cohort_retention(customers, df)
    assert as_list(got.select(
        "cohort_size", "months_since_acquisition", "retained_customers", "retention_rate_pct"
    )) == [(2, 0, 1, 50.0), (2, 2, 1, 50.0)]


def interco(sub, customer, amount, d="2024-01-01"):
    gl = {"SUB_A": "INTERCO_REVENUE", "SUB_B": "INTERCO_FREIGHT", "SUB_D": "INTERCO_SUPPLIES"}[sub]
    return ("p", sub, customer, d, gl, amount)


def test_symmetric_pair_is_listed_once(spark, facts):
    df = facts(interco("SUB_B", "c1", "5.00"), interco("SUB_A", "c1", "7.00"),
               interco("SUB_A", "c2", "7.00"), interco("SUB_B", "c1", "7.00", "2024-01-02"))
    got = marts_group.intercompany_elimination(df, gl_mapping(spark))
    assert as_list(got.select(
        "seller_subsidiary", "buyer_subsidiary", "elimination_debit_php", "amount_difference"
    )) == [("SUB_A", "SUB_B", Decimal("-7.00"), Decimal("2.00"))]


def test_pair_counts_agree_with_the_pairs(spark, facts):
    amounts = ["1.00", "2.00", "2.00", None]
    df = facts(*[
        interco(sub, customer, amounts[(i + j) % 4])
        for i in range(9) for j, sub in enumerate(("SUB_A", "SUB_B", "SUB_D"))
        for customer in ("c1", f"c{i}")
    ])
    pairs = marts_group.intercompany_elimination(df, gl_mapping(spark))
    counts = unbalanced_pair_counts(df, gl_mapping(spark)).filter("pairs > 0")
    keys = ["seller_subsidiary", "buyer_subsidiary"]
    listed = pairs.groupBy(*keys).agg(F.count("*").alias("n"))
    broken = unbalanced_pairs(pairs).groupBy(*keys).agg(F.count("*").alias("b"))
    assert as_set(counts) == as_set(listed.join(broken, keys))


def test_hot_key_join_equals_a_plain_join(spark):
    left = spark.range(700).select(
        F.when(F.col("id") < 300, 0).otherwise(F.col("id") % 40).alias("k"), F.col("id").alias("a"))
    right = spark.range(200).select((F.col("id") % 50).alias("k"), F.col("id").alias("b"))
    salted = hot_key_join(left, right, ["k"], split_by="a", hot_rows=16)
    assert as_list(salted) == as_list(left.join(right, ["k"]))


def test_ordered_pairs_are_all_pairs_once(spark):
    """Hot keys, a kind that is missing, single rows and NULL keys; cells of a few rows."""
    df = spark.range(900).select(
        F.when(F.col("id") < 500, 0).when(F.col("id") < 520, F.lit(None)).otherwise(F.col("id") % 60).alias("k"),
        F.concat(F.lit("S"), F.pmod(F.xxhash64("id"), F.lit(3)).cast("string")).alias("s"),
        F.col("id"),
    )
    got = ordered_pairs(df, ["k"], "s", "id", ("l_", "r_"), cell_rows=10)
    plain = df.alias("l").join(df.alias("r"), F.expr("l.k = r.k AND l.s < r.s")).selectExpr(
        "l.k", "l.s AS l_s", "l.id AS l_id", "r.s AS r_s", "r.id AS r_id")
    assert as_list(got.select(*plain.columns)) == as_list(plain)
    assert got.count() > 50_000


def test_pairs_of_a_hot_key_are_made_in_cells(spark, facts, monkeypatch):
    """No cell, and so no task's share of one key, holds more than its part of the grid."""
    df = spark.range(4000).select(
        F.lit(1).alias("k"), F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("s"), "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        pairs = ordered_pairs(df, ["k"], "s", "id", ("l_", "r_"), cell_rows=250)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert "_a_cell" in plan and pairs.count() == 2000 * 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_zero_denominators_give_null(rows, cal):
    shipments = rows(
        "transaction_date date, origin_city string, dest_city string, service_type string, "
        "weight_kg decimal(10,2), volume_cbm decimal(10,2), freight_revenue decimal(15,2), "
        "fuel_surcharge decimal(15,2), amount_local decimal(15,2), delay_days int",
        (day("2024-01-01"), "a", "b", "s", Decimal(0), Decimal(1), Decimal(1), Decimal(1),
         Decimal(2), 0))
    row = marts_business.freight_ops(shipments, cal, 366).first()
    assert row.revenue_per_kg is None and row.otd_rate_pct == 100.0
    assert row.route == "a → b"
    orders = rows(
        "transaction_date date, confirmed_del date, plant string, sales_org string, "
        "doc_type string, order_qty int, delivered_qty int, amount_local decimal(15,2), "
        "status string", (day("2024-01-01"), day("2024-01-04"), "p", "s", "d", 0, 0,
                          Decimal(0), "OPEN"))
    row = marts_business.order_fulfillment(orders, cal, 366).first()
    assert row.fill_rate_pct is None and row.avg_lead_time_days == 3.0


def test_nothing_billed_has_no_collection_rate(rows, cal):
    staged = "transaction_date date, amount_local decimal(15,2)"
    sales = rows(staged, (day("2024-01-01"), Decimal(0)))
    freight = rows(staged + ", delay_days int", (day("2024-01-01"), Decimal(9), 8),
                   (day("2024-01-02"), Decimal(1), 7), (day("2024-01-02"), Decimal(5), 0))
    loans = rows("transaction_date date, monthly_payment decimal(15,2), days_past_due int, "
                 "loan_status string", (day("2024-01-01"), Decimal(4), 30, "CURRENT"),
                 (day("2024-01-01"), Decimal(4), 60, "CLOSED"))
    got = marts_business.cash_collection(sales, freight, loans, cal, 366).select(
        "subsidiary_code", "collected_on_time_php", "collected_1_7d_php", "collected_7d_plus_php",
        "avg_dso_days", "on_time_collection_rate_pct", "est_outstanding_php")
    d = Decimal
    assert as_list(got) == [
        ("SUB_A", d("0.00"), d("0.00"), d("0.00"), 0.0, None, d("0.00")),
        ("SUB_B", d("5.00"), d("1.00"), d("9.00"), 5.0, 33.33, d("9.00")),
        ("SUB_C", d("0.00"), d("4.00"), d("0.00"), 30.0, 0.0, d("0.00")),
    ]


def test_lease_without_active_units(rows):
    leases = rows(
        "lease_type string, unit_type string, city string, status string, area_sqm decimal(10,2), "
        "monthly_rent_php decimal(15,2), annual_rent_php decimal(15,2), "
        "security_deposit decimal(15,2), rent_escalation_pct decimal(5,2), end_date date",
        ("l", "u", "c", "EXPIRED", Decimal(1), Decimal(1), Decimal(12), Decimal(2), Decimal(3),
         day("2024-01-01")),
        ("l", "u", "d", "ACTIVE", Decimal(1), Decimal(1), Decimal(12), Decimal(2), Decimal(3),
         day("2024-03-31")),
        ("l", "u", "d", "ACTIVE", Decimal(1), Decimal(3), Decimal(36), Decimal(6), Decimal(5),
         day("2024-04-01")))
    got = marts_business.lease_portfolio(leases, day("2024-01-01")).select(
        "city", "occupancy_rate_pct", "wtd_avg_escalation_pct", "expiring_90d_count")
    assert as_list(got.fillna(-1.0)) == [("c", 0.0, -1.0, 0), ("d", 100.0, 4.5, 1)]


def test_calendar(spark):
    got = calendar(spark, day("2018-01-01"), day("2030-12-31"))
    assert got.count() == 4747
    row = got.filter("date_key = DATE'2024-12-29'").first()
    assert (row.day_of_week, row.day_name, row.is_weekend, row.month_name, row.year_month,
            row.year_quarter, row.week_of_year) == (1, "Sun", True, "Dec", "2024-12", "2024-Q4", 52)


def test_spend_growth_stays_in_its_category(rows):
    from decimal import Decimal

    from groupledger.plans.marts_group import with_spend_shares

    totals = rows(
        "subsidiary_code string, cost_center string, product_category string, year int, "
        "month_num int, total_spend_php decimal(18,2)",
        ("A", "c", "X", 2024, 1, Decimal(100)), ("A", "c", "Y", 2024, 1, Decimal(400)),
        ("A", "c", "X", 2024, 2, Decimal(200)),
    )
    got = {(r.product_category, r.month_num): r.mom_spend_change_pct
           for r in with_spend_shares(totals).collect()}
    assert got["X", 1] is None and got["Y", 1] is None
    assert float(got["X", 2]) == 100.0
