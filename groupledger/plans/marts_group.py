"""Marts over the unified fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import month_boundaries, month_start
from ..functions.keys import packed, unpacked
from ..functions.numbers import average, money_sum, percent, ratio
from ..operators.fx import HOME_CURRENCY, with_rate
from ..operators.joins import bounded, ordered_pairs
from ..operators.windows import rank_desc, share_of_total, with_growth
from ..schemas import MONEY_SUM

PERIOD = ("year", "month_num", "month_name")

# Ledger codes the consolidated result counts as revenue.
REVENUE_CODES = (
    "RETAIL_REVENUE",
    "FREIGHT_REVENUE",
    "MANUFACTURING_REVENUE",
    "INTEREST_INCOME",
    "RENTAL_INCOME",
)


def _is_revenue() -> Column:
    return F.col("gl_account_code").like("%REVENUE%")


def in_period(facts: DataFrame, calendar: DataFrame, days: int) -> DataFrame:
    """Facts with the calendar attributes of their day; other days drop out."""
    attributes = calendar.withColumnRenamed("date_key", "transaction_date")
    return facts.join(bounded(attributes, days), "transaction_date")


def consolidated_pnl(facts: DataFrame, subsidiaries: DataFrame) -> DataFrame:
    """Revenue by year, quarter, month name, subsidiary and ledger code."""
    day = F.col("transaction_date")
    revenue = facts.filter(F.col("gl_account_code").isin(*REVENUE_CODES) | _is_revenue())
    grouped = (
        revenue.join(subsidiaries, ["subsidiary_code"])
        .groupBy(
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.date_format(day, "MMMM").alias("month_name"),
            "subsidiary_code",
            "subsidiary_name",
            "industry_type",
            "gl_account_code",
        )
        .agg(
            money_sum("amount_php").alias("revenue_php"),
            F.count_distinct("customer_id_nk").alias("unique_customers"),
            F.count("*").alias("transaction_count"),
        )
    )
    return grouped.withColumn(
        "revenue_per_customer", ratio(F.col("revenue_php"), F.col("unique_customers"), 2)
    )


def interco_postings(facts: DataFrame, mapping: DataFrame) -> DataFrame:
    """Postings to the ledger codes that the group books as intercompany revenue."""
    codes = mapping.filter(F.col("gl_sub_category") == "INTERCOMPANY_REVENUE").select(
        "subsidiary_code", F.col("subsidiary_gl_code").alias("gl_account_code")
    )
    return facts.join(codes, ["gl_account_code", "subsidiary_code"]).select(
        "transaction_key",
        "subsidiary_code",
        "customer_id_nk",
        "transaction_date",
        "gl_account_code",
        "amount_php",
    )


def intercompany_elimination(facts: DataFrame, mapping: DataFrame) -> DataFrame:
    """Postings of two subsidiaries to one customer on one day, each pair once, that of the
    subsidiary with the lesser code as the seller's.

    The pairs are the result, so a busy customer-day makes many; they are made
    in cells of a grid, by as many tasks as they need. Their keys are shuffled packed.
    """
    postings = interco_postings(facts, mapping).withColumnsRenamed({
        "transaction_key": "key", "subsidiary_code": "subsidiary", "gl_account_code": "gl_code",
    }).withColumn("key", packed("key"))
    pairs = ordered_pairs(
        postings, ["customer_id_nk", "transaction_date"], "subsidiary", "key",
        ("seller_", "buyer_"),
    )
    sold, bought = F.col("seller_amount_php"), F.col("buyer_amount_php")
    return pairs.select(
        unpacked("seller_key").alias("selling_txn_key"),
        unpacked("buyer_key").alias("buying_txn_key"),
        "seller_subsidiary",
        "buyer_subsidiary",
        F.col("customer_id_nk").alias("shared_counterparty"),
        "transaction_date",
        "seller_gl_code",
        "buyer_gl_code",
        "seller_amount_php",
        "buyer_amount_php",
        sold.alias("interco_amount_php"),
        (-sold).alias("elimination_debit_php"),
        bought.alias("elimination_credit_php"),
        F.abs(sold - bought).cast("decimal(19,2)").alias("amount_difference"),
    )


def customer_360(customers: DataFrame, facts: DataFrame) -> DataFrame:
    """Customer and type across subsidiaries.

    Facts are first brought down to one row per customer and subsidiary, which
    takes the weight off a customer with very many transactions.
    """
    keys = ["customer_id_nk", "subsidiary_code"]
    business = facts.groupBy(*keys).agg(
        F.sum("amount_php").alias("revenue"),
        F.min("transaction_date").alias("first_day"),
        F.max("transaction_date").alias("last_day"),
        F.count("*").alias("n"),
    )
    return (
        customers.select(*keys, "customer_type")
        .join(business, keys)
        .groupBy("customer_id_nk", "customer_type")
        .agg(
            F.array_sort(F.collect_set("subsidiary_code")).alias("subsidiaries"),
            money_sum("revenue").alias("total_group_revenue_php"),
            F.min("first_day").alias("first_transaction"),
            F.max("last_day").alias("last_transaction"),
            F.sum("n").alias("total_transactions"),
        )
        .withColumn("subsidiary_count", F.size("subsidiaries").cast("bigint"))
        .select(
            "customer_id_nk",
            "customer_type",
            "subsidiary_count",
            "subsidiaries",
            "total_group_revenue_php",
            "first_transaction",
            "last_transaction",
            "total_transactions",
        )
    )


def subsidiary_kpi(
    facts: DataFrame, subsidiaries: DataFrame, calendar: DataFrame, days: int
) -> DataFrame:
    """Monthly revenue per subsidiary with growth and share of the group."""
    monthly = (
        in_period(facts.filter(_is_revenue()), calendar, days)
        .join(subsidiaries, ["subsidiary_code"])
        .groupBy("subsidiary_code", "subsidiary_name", "industry_type", *PERIOD)
        .agg(
            F.count("*").alias("transaction_count"),
            F.count_distinct("customer_id_nk").alias("active_customers"),
            money_sum("amount_php").alias("revenue_php"),
            average(F.col("amount_php"), 6).alias("avg_transaction_php"),
        )
    )
    grown = with_growth(
        monthly, "revenue_php", ["subsidiary_code"], ["year", "month_num"],
        "mom_revenue_growth_pct",
    )
    return grown.withColumn(
        "group_revenue_share_pct", share_of_total("revenue_php", ["year", "month_num"])
    )


def fx_exposure(
    facts: DataFrame, calendar: DataFrame, days: int, rates: DataFrame, rate_rows: int
) -> DataFrame:
    """Monthly amounts per subsidiary and currency with a 5 % rate sensitivity."""
    keys = (*PERIOD, "subsidiary_code", "currency_code")
    monthly = (
        with_rate(in_period(facts, calendar, days), rates, rate_rows, "usd_php_rate")
        .groupBy(*keys)
        .agg(
            F.count("*").alias("transaction_count"),
            money_sum("amount_local").alias("total_local_amount"),
            money_sum("amount_php").alias("total_php_equivalent"),
            average(F.col("usd_php_rate"), 6).alias("avg_fx_rate"),
        )
    )
    total = F.col("total_php_equivalent")
    sensitivity = F.round(total * F.lit("0.05").cast("decimal(3,2)"), 2).cast(MONEY_SUM)
    return monthly.select(
        *keys,
        (F.col("currency_code") != HOME_CURRENCY).alias("is_fx_exposed"),
        "transaction_count",
        "total_local_amount",
        "total_php_equivalent",
        sensitivity.alias("fx_sensitivity_5pct_php"),
        "avg_fx_rate",
        share_of_total("total_php_equivalent", ["year", "month_num"]).alias(
            "currency_revenue_share_pct"
        ),
    ).orderBy("year", "month_num", "subsidiary_code", "currency_code")


def product_performance(
    facts: DataFrame, products: DataFrame, calendar: DataFrame, days: int
) -> DataFrame:
    """Monthly revenue per product category and cost centre with rank and shares.

    Postings are shuffled with their hash keys packed, to their products and to be counted."""
    product = packed("product_key").alias("product_key")
    lookup = products.select(product, "subsidiary_code", "product_category", "cost_center")
    revenue = facts.filter(_is_revenue()).select(
        product, packed("transaction_key").alias("transaction_key"),
        "subsidiary_code", "transaction_date", "customer_id_nk", "amount_php",
    )
    monthly = (
        in_period(revenue, calendar, days)
        .join(lookup, ["product_key", "subsidiary_code"])
        .groupBy(*PERIOD, "subsidiary_code", "product_category", "cost_center")
        .agg(
            F.count_distinct("transaction_key").alias("transaction_count"),
            F.count_distinct("customer_id_nk").alias("unique_customers"),
            money_sum("amount_php").alias("revenue_php"),
        )
    )
    month = ["year", "month_num"]
    own = ["subsidiary_code", *month]
    return monthly.select(
        "*",
        ratio(F.col("revenue_php"), F.col("transaction_count"), 2).alias("avg_revenue_per_txn"),
        rank_desc("revenue_php", own).alias("category_revenue_rank"),
        share_of_total("revenue_php", own).alias("subsidiary_category_share_pct"),
        share_of_total("revenue_php", month).alias("group_category_share_pct"),
    ).orderBy(*month, "subsidiary_code", F.col("revenue_php").desc_nulls_first())


def gl_account_bridge(
    facts: DataFrame, mapping: DataFrame, calendar: DataFrame, days: int
) -> DataFrame:
    """Monthly balances per subsidiary ledger code and the group code it maps to."""
    codes = mapping.withColumnRenamed("subsidiary_gl_code", "gl_account_code")
    monthly = (
        in_period(facts, calendar, days)
        .join(codes, ["gl_account_code", "subsidiary_code"])
        .groupBy(
            *PERIOD,
            "subsidiary_code",
            "group_gl_code",
            "group_gl_name",
            "gl_category",
            "gl_sub_category",
            F.col("gl_account_code").alias("subsidiary_gl_code"),
        )
        .agg(
            money_sum("amount_php").alias("balance_php"),
            F.count("*").alias("posting_count"),
        )
    )
    share = share_of_total("balance_php", ["group_gl_code", "year", "month_num"])
    return monthly.withColumn("subsidiary_gl_share_pct", share).orderBy(
        "year", "month_num", "group_gl_code", "subsidiary_code"
    )


#: The fact's columns that the totals are made of.
SPEND_COLUMNS = ("subsidiary_code", "product_key", "transaction_date", "gl_account_code", "amount_php")


def cost_center_totals(
    facts: DataFrame, products: DataFrame, calendar: DataFrame, days: int
) -> DataFrame:
    """Monthly non-revenue postings per subsidiary, cost centre and category.

    Postings are summed per product and month before the product join, so a
    product with very many postings is one row per month when it shuffles, with its
    hash key packed.
    """
    code, product = F.col("gl_account_code"), packed("product_key").alias("product_key")
    spend = facts.filter(~code.like("%REVENUE%") & ~code.like("%INCOME%")).select(
        product, "subsidiary_code", "transaction_date", "amount_php"
    )
    per_product = (
        in_period(spend, calendar, days)
        .groupBy(*PERIOD, "subsidiary_code", "product_key")
        .agg(
            F.count("*").alias("postings"),
            F.sum("amount_php").alias("spend"),
            F.count("amount_php").alias("valued"),
        )
    )
    lookup = products.select(product, "subsidiary_code", "product_category", "cost_center")
    return (
        per_product.join(lookup, ["product_key", "subsidiary_code"])
        .groupBy(*PERIOD, "subsidiary_code", "cost_center", "product_category")
        .agg(
            F.sum("postings").alias("posting_count"),
            money_sum("spend").alias("total_spend_php"),
            ratio(F.sum("spend"), F.sum("valued"), 2).alias("avg_posting_php"),
        )
    )


def with_spend_shares(totals: DataFrame) -> DataFrame:
    """Growth per cost centre line and shares, over the whole of the totals."""
    month = ["year", "month_num"]
    grown = with_growth(
        totals, "total_spend_php", ["subsidiary_code", "cost_center", "product_category"],
        month, "mom_spend_change_pct",
    )
    return grown.select(
        "*",
        share_of_total("total_spend_php", ["subsidiary_code", *month]).alias(
            "subsidiary_spend_share_pct"
        ),
        share_of_total("total_spend_php", month).alias("group_spend_share_pct"),
    )


def cost_center_spend(
    facts: DataFrame, products: DataFrame, calendar: DataFrame, days: int
) -> DataFrame:
    return with_spend_shares(cost_center_totals(facts, products, calendar, days))


def cohort_retention(customers: DataFrame, facts: DataFrame) -> DataFrame:
    """Share of each month's new customers that buy again n months later.

    Facts come down to the distinct months of a customer before the join; a day
    is on or after a month start exactly when its own month is.
    """
    keys = ["customer_id_nk", "subsidiary_code"]
    cohorts = customers.filter(F.col("acquire_date").isNotNull()).select(
        *keys, month_start(F.col("acquire_date")).alias("cohort_month")
    )
    sizes = cohorts.groupBy("subsidiary_code", "cohort_month").agg(
        F.count_distinct("customer_id_nk").alias("cohort_size")
    )
    active = facts.select(
        *keys, month_start(F.col("transaction_date")).alias("activity_month")
    ).distinct()
    retained = (
        cohorts.join(active, keys)
        .filter(F.col("activity_month") >= F.col("cohort_month"))
        .groupBy(
            "subsidiary_code",
            "cohort_month",
            month_boundaries(F.col("cohort_month"), F.col("activity_month")).alias(
                "months_since_acquisition"
            ),
        )
        .agg(F.count_distinct("customer_id_nk").alias("retained_customers"))
    )
    return (
        retained.join(sizes, ["subsidiary_code", "cohort_month"])
        .select(
            "subsidiary_code",
            "cohort_month",
            "cohort_size",
            "months_since_acquisition",
            "retained_customers",
            percent(F.col("retained_customers"), F.col("cohort_size")).alias(
                "retention_rate_pct"
            ),
        )
        .orderBy("subsidiary_code", "cohort_month", "months_since_acquisition")
    )
