"""Small reference tables stated in code."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..schemas import GL_MAPPING, INGESTION_CONFIG, SUBSIDIARY

# The five subsidiaries.
SUBSIDIARIES = [
    ("SUB_A", "RetailCo", "Retail", "PHP"),
    ("SUB_B", "LogisticsCo", "Freight", "PHP"),
    ("SUB_C", "FinanceCo", "Lending", "PHP"),
    ("SUB_D", "ManufactureCo", "Manufacturing", "PHP"),
    ("SUB_E", "PropertyCo", "Real Estate", "PHP"),
]
CODES = tuple(row[0] for row in SUBSIDIARIES)

# Subsidiary ledger code to group ledger code.
GL_ACCOUNTS = [
    ("SUB_A", "RETAIL_REVENUE", "GRP-4100", "Group Product Revenue", "REVENUE", "PRODUCT_REVENUE"),
    ("SUB_A", "RETAIL_COGS", "GRP-5100", "Group Cost of Goods Sold", "COGS", "PRODUCT_COGS"),
    ("SUB_A", "RETAIL_OPEX", "GRP-6100", "Group Selling & Distribution Expense", "OPEX", "SELLING_OPEX"),
    ("SUB_A", "INTERCO_REVENUE", "GRP-4900", "Intercompany Revenue (Elimination)", "REVENUE", "INTERCOMPANY_REVENUE"),
    ("SUB_B", "FREIGHT_REVENUE", "GRP-4200", "Group Freight & Logistics Revenue", "REVENUE", "FREIGHT_REVENUE"),
    ("SUB_B", "FUEL_COST", "GRP-5200", "Group Fuel & Fleet Cost", "COGS", "LOGISTICS_COGS"),
    ("SUB_B", "LOGISTICS_OPEX", "GRP-6200", "Group Logistics Operating Expense", "OPEX", "LOGISTICS_OPEX"),
    ("SUB_B", "INTERCO_FREIGHT", "GRP-4910", "Intercompany Freight Revenue (Elimination)", "REVENUE", "INTERCOMPANY_REVENUE"),
    ("SUB_C", "INTEREST_INCOME", "GRP-4300", "Group Interest & Fee Income", "REVENUE", "INTEREST_INCOME"),
    ("SUB_C", "LOAN_PROVISION", "GRP-5300", "Group Credit Loss Provision", "COGS", "CREDIT_PROVISION"),
    ("SUB_C", "BANKING_OPEX", "GRP-6300", "Group Banking & Financial Services Expense", "OPEX", "BANKING_OPEX"),
    ("SUB_C", "INTERCO_INTEREST", "GRP-4920", "Intercompany Interest Income (Elimination)", "REVENUE", "INTERCOMPANY_REVENUE"),
    ("SUB_D", "MANUFACTURING_REVENUE", "GRP-4400", "Group Manufacturing & Product Sales Revenue", "REVENUE", "PRODUCT_REVENUE"),
    ("SUB_D", "RAW_MATERIAL_COST", "GRP-5400", "Group Raw Material & Production Cost", "COGS", "MANUFACTURING_COGS"),
    ("SUB_D", "PLANT_OPEX", "GRP-6400", "Group Plant & Manufacturing Overhead", "OPEX", "PLANT_OPEX"),
    ("SUB_D", "INTERCO_SUPPLIES", "GRP-4930", "Intercompany Supplies Revenue (Elimination)", "REVENUE", "INTERCOMPANY_REVENUE"),
    ("SUB_E", "RENTAL_INCOME", "GRP-4500", "Group Rental & Lease Revenue", "REVENUE", "RENTAL_REVENUE"),
    ("SUB_E", "PROPERTY_DEPRECIATION", "GRP-5500", "Group Property Depreciation", "COGS", "DEPRECIATION"),
    ("SUB_E", "PROPERTY_OPEX", "GRP-6500", "Group Property & Facilities Expense", "OPEX", "PROPERTY_OPEX"),
    ("SUB_E", "INTERCO_LEASE", "GRP-4940", "Intercompany Lease Revenue (Elimination)", "REVENUE", "INTERCOMPANY_REVENUE"),
]

# One line per source table; a first run has no load mark yet.
INGESTION = [
    ("SUB_A", "sub_a_pos", "sales_transactions", "bronze", "raw_sub_a_sales", "INCREMENTAL", "updated_at", "order_id", True),
    ("SUB_A", "sub_a_pos", "customers", "bronze", "raw_sub_a_customers", "FULL", None, "customer_id", True),
    ("SUB_B", "sub_b_tms", "shipments", "bronze", "raw_sub_b_shipments", "INCREMENTAL", "modified_ts", "shipment_id", True),
    ("SUB_C", "sub_c_core", "loan_accounts", "bronze", "raw_sub_c_loans", "INCREMENTAL", "last_updated", "loan_id", True),
    ("SUB_D", "sub_d_sap", "sales_orders", "bronze", "raw_sub_d_orders", "INCREMENTAL", "change_date", "order_num", True),
    ("SUB_E", "sub_e_pms", "lease_contracts", "bronze", "raw_sub_e_leases", "FULL", None, "contract_id", True),
]


def local_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Literal rows as a local relation, whose true size Spark sees when it plans joins."""
    arrow = to_arrow_schema(schema)
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)


def subsidiaries(spark: SparkSession) -> DataFrame:
    return local_rows(spark, SUBSIDIARIES, SUBSIDIARY)


def gl_mapping(spark: SparkSession) -> DataFrame:
    return local_rows(spark, GL_ACCOUNTS, GL_MAPPING)


def ingestion_config(spark: SparkSession, marks: dict | None = None) -> DataFrame:
    """The control rows; ``marks`` gives the load mark of some target tables."""
    rows = [row + ((marks or {}).get(row[4]),) for row in INGESTION]
    return local_rows(spark, rows, INGESTION_CONFIG)
