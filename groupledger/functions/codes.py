"""Code normalisation by lookup."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# Retail segment to customer type.
CUSTOMER_TYPE = {
    "VIP": "HIGH_VALUE",
    "Regular": "STANDARD",
    "New": "NEW",
    "At-Risk": "AT_RISK",
}

# Raw loan status to portfolio status.
LOAN_STATUS = {
    "Current": "CURRENT",
    "Grace Period": "GRACE_PERIOD",
    "30 DPD": "30DPD",
    "60 DPD": "60DPD",
    "90 DPD": "90DPD",
    "120+ DPD": "NPL",
    "Past Due": "NPL",
    "Default": "NPL",
    "Non-Performing Loan (NPL)": "NPL",
    "Under Collection": "NPL",
    "Legal Action": "NPL",
    "Restructured": "RESTRUCTURED",
    "Refinanced": "RESTRUCTURED",
    "Foreclosed": "CHARGED_OFF",
    "Charged Off": "CHARGED_OFF",
    "Written Off": "CHARGED_OFF",
    "Closed": "CLOSED",
    "Paid Off": "CLOSED",
}


def recode(col: Column, table: Mapping[str, str], default: Column) -> Column:
    """Translate through a literal map; values outside it take the default."""
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[col], default)


def customer_type(segment: Column) -> Column:
    return recode(segment, CUSTOMER_TYPE, F.lit("UNKNOWN"))


def loan_status(raw: Column) -> Column:
    return recode(raw, LOAN_STATUS, raw)
