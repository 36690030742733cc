"""Hash keys."""

from pyspark.sql import Column, functions as F


def surrogate_key(*parts: Column) -> Column:
    """Hex md5 of the parts put end to end; NULL as soon as one part is NULL."""
    return F.md5(F.concat(*[p.cast("string") for p in parts]))


def packed(key: str) -> Column:
    """A text key for shuffles: one of lower-case hex digits, as ``surrogate_key`` makes them,
    takes half its bytes; any other stays text. Different keys stay different, NULL stays NULL."""
    text = F.col(key)
    digits = F.unhex(text)
    whole = F.coalesce(F.lower(F.hex(digits)) == text, F.lit(False))
    return F.when(
        text.isNotNull(),
        F.struct(F.when(whole, digits).alias("digits"), F.when(~whole, text).alias("text")),
    )


def unpacked(key: str) -> Column:
    """The text of a ``packed`` key."""
    return F.coalesce(F.lower(F.hex(F.col(key)["digits"])), F.col(key)["text"])


def product_id(subsidiary: str) -> Column:
    """Natural product id of a staged row of the subsidiary."""
    return {
        "SUB_A": lambda: F.col("product_sku"),
        "SUB_B": lambda: F.col("service_type"),
        "SUB_C": lambda: F.col("loan_type"),
        "SUB_D": lambda: F.col("material_id"),
        "SUB_E": lambda: F.concat(F.col("lease_type"), F.lit("|"), F.col("unit_type")),
    }[subsidiary]()
