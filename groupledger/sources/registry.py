"""Which landing file feeds which raw table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from ..schemas import BRONZE


@dataclass(frozen=True)
class LandingFile:
    table: str
    path: str
    subsidiary: str

    @property
    def schema(self) -> T.StructType:
        return BRONZE[self.table]


# Raw table, file below the landing folder, owning subsidiary.
LANDING = (
    LandingFile("raw_sub_a_sales", "sub_a/sales_transactions.csv", "SUB_A"),
    LandingFile("raw_sub_a_customers", "sub_a/customers.csv", "SUB_A"),
    LandingFile("raw_sub_b_shipments", "sub_b/shipments.csv", "SUB_B"),
    LandingFile("raw_sub_c_loans", "sub_c/loan_accounts.csv", "SUB_C"),
    LandingFile("raw_sub_d_orders", "sub_d/sales_orders.csv", "SUB_D"),
    LandingFile("raw_sub_e_leases", "sub_e/lease_contracts.csv", "SUB_E"),
)
