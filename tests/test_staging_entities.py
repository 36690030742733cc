"""Staging and entities on a few rows each."""

from decimal import Decimal

import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from groupledger.functions.codes import customer_type, loan_status
from groupledger.functions.dates import month_boundaries
from groupledger.operators.fx import to_home_currency
from groupledger.plans import entities, staging
from groupledger.schemas import BRONZE, CANONICAL

from .conftest import as_set, at, day

T0 = at("2024-01-05 10:00:00")


def raw(spark, table, **values):
    """One raw row; columns not given are NULL."""
    schema = BRONZE[table]
    return spark.createDataFrame([tuple(values.get(f.name) for f in schema)], schema)


def sales(spark, **values):
    row = dict(order_id="o1", customer_id="c1", order_date=T0, net_sales=Decimal("10.00"),
               product_sku="s1", category="X", updated_at=T0)
    return staging.retail(raw(spark, "raw_sub_a_sales", **{**row, **values}))


def order(spark, **values):
    row = dict(order_num="1", order_item="10", customer_id="c1", order_date=T0,
               order_value_php=Decimal("5.00"), delivered_qty="085", change_date=T0,
               material_id="m", plant="P1")
    return raw(spark, "raw_sub_d_orders", **{**row, **values})


@pytest.mark.parametrize("code", list(staging.VIEWS))
def test_staged_views_share_the_canonical_columns(spark, code):
    table, view = staging.VIEWS[code]
    staged = view(raw(spark, table))
    types = {f.name: f.dataType for f in staged.schema}
    assert {f.name: types[f.name] for f in CANONICAL} == {f.name: f.dataType for f in CANONICAL}


def test_defaults_for_currency_and_ledger_code(spark):
    row = sales(spark).first()
    assert (row.currency_code, row.gl_account_code) == ("PHP", "RETAIL_REVENUE")
    assert sales(spark, currency="USD").first().currency_code == "USD"


def test_padded_quantity_becomes_a_number(spark):
    row = staging.orders(order(spark)).first()
    assert row.delivered_qty == 85
    assert row.transaction_nk == "1-10"


def test_malformed_quantity_fails(spark):
    with pytest.raises(NumberFormatException):
        staging.orders(order(spark, delivered_qty="08x")).collect()


def test_codes(rows):
    df = rows("s string", ("VIP",), ("At-Risk",), ("Gold",), (None,))
    assert [r[0] for r in df.select(customer_type(F.col("s"))).collect()] == [
        "HIGH_VALUE", "AT_RISK", "UNKNOWN", "UNKNOWN"]
    df = rows("s string", ("Legal Action",), ("Paid Off",), ("Foo",), (None,))
    assert [r[0] for r in df.select(loan_status(F.col("s"))).collect()] == [
        "NPL", "CLOSED", "Foo", None]


def test_month_boundaries_ignore_the_day(rows):
    df = rows("a date, b date", (day("2024-01-31"), day("2024-02-01")),
              (day("2023-12-01"), day("2024-01-31")), (day("2024-05-01"), day("2024-05-31")))
    got = [r[0] for r in df.select(month_boundaries(F.col("a"), F.col("b"))).collect()]
    assert got == [1, 1, 0]


def test_conversion(rows):
    facts = rows(
        "transaction_date date, currency_code string, amount_local decimal(15,2)",
        (day("2024-01-01"), "PHP", Decimal("5.00")),
        (day("2024-01-01"), "USD", Decimal("5.00")),
        (day("2024-01-02"), "USD", Decimal("5.00")),
        (day("2024-01-01"), "EUR", Decimal("5.00")),
    )
    rates = rows(
        "rate_date date, from_currency string, rate decimal(18,8)",
        (day("2024-01-01"), "USD", Decimal("0.02")), (day("2024-01-02"), "USD", Decimal("0")),
    )
    got = to_home_currency(facts, rates, 2).select("transaction_date", "currency_code", "amount_php")
    assert as_set(got) == {
        (day("2024-01-01"), "PHP", Decimal("5.00")),
        (day("2024-01-01"), "USD", Decimal("250.00")),
        (day("2024-01-02"), "USD", None),  # rate 0
        (day("2024-01-01"), "EUR", None),  # no rate
    }


def test_product_with_two_categories_takes_the_latest(spark):
    old = sales(spark, category="A", updated_at=at("2024-01-01 00:00:00"))
    new = sales(spark, category="B", updated_at=at("2024-02-01 00:00:00"))
    got = entities.products({"SUB_A": old.unionByName(new)}).collect()
    assert [(r.product_id_nk, r.product_category, r.cost_center) for r in got] == [
        ("s1", "B", "CC-RETAIL-B")]


def test_customer_is_acquired_on_the_first_transaction(spark):
    early = order(spark, order_date=at("2023-06-01 00:00:00"))
    staged = staging.orders(early.unionByName(order(spark)))
    empty = {c: v(raw(spark, t)).limit(0) for c, (t, v) in staging.VIEWS.items()}
    got = entities.customers({**empty, "SUB_D": staged}, raw(spark, "raw_sub_a_customers").limit(0))
    assert [(r.customer_id_nk, r.acquire_date, r.full_name) for r in got.collect()] == [
        ("c1", day("2023-06-01"), None)]
