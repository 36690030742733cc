"""Conformed entities across the five subsidiaries."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.codes import customer_type
from ..functions.keys import product_id, surrogate_key
from ..operators.fx import to_home_currency
from ..schemas import ACCOUNT, CUSTOMER, PRODUCT, TRANSACTION

# Customer type and industry where the customers have no master table.
DERIVED_CUSTOMERS = {
    "SUB_B": ("B2B", "FREIGHT"),
    "SUB_C": ("BORROWER", "LENDING"),
    "SUB_D": ("B2B", "MANUFACTURING"),
    "SUB_E": ("TENANT", "REAL_ESTATE"),
}

# Account type where all of a customer's business is one account.
CUSTOMER_ACCOUNTS = {
    "SUB_A": "RETAIL_ACCOUNT",
    "SUB_B": "FREIGHT_ACCOUNT",
    "SUB_D": "MANUFACTURING_ACCOUNT",
}

# Account type column or constant where every contract is an account.
CONTRACT_ACCOUNTS = {"SUB_C": F.col, "SUB_E": F.lit}
CONTRACT_ACCOUNT_TYPE = {"SUB_C": "loan_type", "SUB_E": "LEASE_ACCOUNT"}


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _in_layout(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def _key(*parts: Column) -> Column:
    return surrogate_key(F.col("subsidiary_code"), *parts)


def customers(staged: Mapping[str, DataFrame], master: DataFrame) -> DataFrame:
    """One row per customer and subsidiary: retail from its master table, the
    others from their transactions, acquired on the first of them."""
    retail = master.select(
        F.lit("SUB_A").alias("subsidiary_code"),
        F.col("customer_id").alias("customer_id_nk"),
        customer_type(F.col("segment")).alias("customer_type"),
        F.lit("RETAIL").alias("industry_segment"),
        F.col("join_date").cast("date").alias("acquire_date"),
        "full_name",
        "email",
        F.col("region").alias("customer_region"),
        F.col("is_active").cast("boolean").alias("is_active"),
    )
    parts = [retail]
    for code, (kind, industry) in DERIVED_CUSTOMERS.items():
        first = staged[code].groupBy("subsidiary_code", "customer_id_nk").agg(
            F.min("transaction_date").alias("acquire_date")
        )
        nothing = F.lit(None).cast("string")
        parts.append(
            first.select(
                "*",
                F.lit(kind).alias("customer_type"),
                F.lit(industry).alias("industry_segment"),
                nothing.alias("full_name"),
                nothing.alias("email"),
                nothing.alias("customer_region"),
                F.lit(True).alias("is_active"),
            )
        )
    keyed = [p.withColumn("customer_key", _key(F.col("customer_id_nk"))) for p in parts]
    return _in_layout(_union(keyed), CUSTOMER)


def accounts(staged: Mapping[str, DataFrame]) -> DataFrame:
    """One account per customer, or per contract for loans and leases."""
    parts = []
    for code in ("SUB_A", "SUB_B", "SUB_C", "SUB_D", "SUB_E"):
        if code in CUSTOMER_ACCOUNTS:
            opened = staged[code].groupBy("subsidiary_code", "customer_id_nk").agg(
                F.min("transaction_date").alias("open_date")
            )
            number, kind = F.col("customer_id_nk"), F.lit(CUSTOMER_ACCOUNTS[code])
        else:
            opened = staged[code].withColumn("open_date", F.col("transaction_date"))
            number = F.col("transaction_nk")
            kind = CONTRACT_ACCOUNTS[code](CONTRACT_ACCOUNT_TYPE[code])
        parts.append(
            opened.select(
                _key(number).alias("account_key"),
                number.alias("account_id_nk"),
                _key(F.col("customer_id_nk")).alias("customer_key"),
                "subsidiary_code",
                kind.alias("account_type"),
                "open_date",
            )
        )
    return _in_layout(_union(parts), ACCOUNT)


def _product_columns(code: str) -> tuple[str, Column, str, Column]:
    """The column of a staged row that tells its product's category and cost centre, and
    category, class and cost centre."""
    col, lit = F.col, F.lit
    return {
        "SUB_A": ("category", col("category"), "RETAIL", F.concat(lit("CC-RETAIL-"), "category")),
        "SUB_B": ("service_type", col("service_type"), "FREIGHT_SERVICE", lit("CC-LOGISTICS-OPS")),
        "SUB_C": (
            "loan_type", col("loan_type"), "LOAN_PRODUCT", F.concat(lit("CC-BANKING-"), "loan_type")
        ),
        "SUB_D": (
            "plant", lit("MANUFACTURED_GOOD"), "MATERIAL", F.concat(lit("CC-PLANT-"), "plant")
        ),
        "SUB_E": (
            "lease_type", col("lease_type"), "LEASE_UNIT",
            F.concat(lit("CC-PROPERTY-"), "lease_type"),
        ),
    }[code]


def products(staged: Mapping[str, DataFrame]) -> DataFrame:
    """One row per product and subsidiary.

    A product seen with several categories or plants takes those of its latest
    load, so the key stays unique and joins to it never multiply rows. Facts are
    first brought down to the versions of each product by hashing, told by the one
    column that they differ in.
    """
    parts = []
    for code, df in staged.items():
        told_by, category, kind, cost_center = _product_columns(code)
        versions = df.groupBy(
            "subsidiary_code", product_id(code).alias("product_id_nk"), told_by
        ).agg(F.max("_loaded_at").alias("_loaded_at"))
        version = F.struct(
            "_loaded_at", category.alias("product_category"), cost_center.alias("cost_center")
        )
        latest = versions.groupBy("subsidiary_code", "product_id_nk").agg(F.max(version).alias("latest"))
        parts.append(
            latest.select(
                _key(F.col("product_id_nk")).alias("product_key"),
                "product_id_nk",
                "subsidiary_code",
                "latest.product_category",
                F.lit(kind).alias("product_class"),
                "latest.cost_center",
                "latest._loaded_at",
            )
        )
    return _in_layout(_union(parts), PRODUCT)


def keyed_facts(code: str, staged: DataFrame) -> DataFrame:
    """Staged rows of one subsidiary with the fact's three hash keys."""
    account = "transaction_nk" if code in CONTRACT_ACCOUNTS else "customer_id_nk"
    return staged.select(
        _key(F.col("transaction_nk")).alias("transaction_key"),
        _key(F.col(account)).alias("account_key"),
        _key(product_id(code)).alias("product_key"),
        "transaction_nk",
        "subsidiary_code",
        "customer_id_nk",
        "transaction_date",
        "amount_local",
        "currency_code",
        "gl_account_code",
        "_loaded_at",
    )


def transactions(staged: Mapping[str, DataFrame], rates: DataFrame, rate_rows: int) -> DataFrame:
    """The unified fact in local and home currency."""
    facts = _union([keyed_facts(code, df) for code, df in staged.items()])
    return _in_layout(to_home_currency(facts, rates, rate_rows), TRANSACTION)
