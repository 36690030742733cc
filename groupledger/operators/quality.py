"""Declarative data-quality rules; each reports its number of failing rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.keys import packed, unpacked

REPORT = ("table_name", "column_name", "rule", "failing_rows")


@dataclass(frozen=True)
class NotNull:
    column: str
    rule = "not_null"

    def fails(self, schema: T.StructType) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Accepted:
    column: str
    values: tuple[Any, ...]
    rule = "accepted_values"

    def fails(self, schema: T.StructType) -> Column:
        return ~F.col(self.column).isin(list(self.values))


@dataclass(frozen=True)
class Between:
    """Bounds are part of the range; a number or a date. Text is read as a number, and text
    that is none fails."""

    column: str
    low: Any
    high: Any
    rule = "between"

    def fails(self, schema: T.StructType) -> Column:
        value = F.col(self.column)
        if isinstance(schema[self.column].dataType, T.StringType):
            number = value.try_cast("double")
            within = number.between(F.lit(self.low), F.lit(self.high))
            return value.isNotNull() & ~F.coalesce(within, F.lit(False))
        return ~value.between(F.lit(self.low), F.lit(self.high))


@dataclass(frozen=True)
class Holds:
    """A condition between columns of one row, such as total = part + part."""

    column: str
    condition: Column
    rule = "reconciles"

    def fails(self, schema: T.StructType) -> Column:
        return ~self.condition


@dataclass(frozen=True)
class Unique:
    """Counts the key values that occur more than once."""

    column: str
    rule = "unique"


@dataclass(frozen=True)
class HasType:
    """Every row fails when the column has another type; no value is looked at."""

    column: str
    type_name: str
    rule = "has_type"

    def fails(self, schema: T.StructType) -> Column:
        return F.lit(schema[self.column].dataType.simpleString() != self.type_name)


@dataclass(frozen=True)
class Related:
    """Counts the rows whose non-NULL key is missing from the parent table."""

    column: str
    parent: str
    parent_column: str
    rule = "relationship"


RowRule = (NotNull, Accepted, Between, Holds, HasType)


def offending_rows(df: DataFrame, rule: Any) -> DataFrame:
    """The rows that break a row rule, for looking at them."""
    return df.filter(rule.fails(df.schema))


def duplicated_keys(df: DataFrame, column: str) -> DataFrame:
    """Key values that occur more than once, with how often. Hash keys are counted packed."""
    hash_key = column.endswith("_key") and isinstance(df.schema[column].dataType, T.StringType)
    key = packed(column).alias(column) if hash_key else F.col(column)
    found = (
        df.filter(F.col(column).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
    )
    return found.withColumn(column, unpacked(column)) if hash_key else found


def orphan_counts(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Foreign-key values without a parent, with their row counts.

    Keys are counted before the join, so a hot key is one row when it shuffles.
    """
    keys = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    parents = parent.select(F.col(parent_column).alias(column)).distinct()
    return keys.join(parents, column, "left_anti")


def _line(df: DataFrame, table: str, rule: Any, count: Column) -> DataFrame:
    return df.agg(count.cast("bigint").alias("failing_rows")).select(
        F.lit(table).alias("table_name"),
        F.lit(rule.column).alias("column_name"),
        F.lit(rule.rule).alias("rule"),
        "failing_rows",
    )


def check_rows(table: str, df: DataFrame, rules: Sequence[Any]) -> DataFrame:
    """All row rules of a table in a single pass over it."""
    totals = df.agg(
        *[F.count_if(rule.fails(df.schema)).alias(f"r{i}") for i, rule in enumerate(rules)]
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(rule.column).alias("column_name"),
                F.lit(rule.rule).alias("rule"),
                F.col(f"r{i}").cast("bigint").alias("failing_rows"),
            )
            for i, rule in enumerate(rules)
        ]
    )
    return totals.select(F.explode(lines).alias("line")).select("line.*")


def check(
    table: str, df: DataFrame, rules: Sequence[Any], parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Report of every rule of a table: (table_name, column_name, rule, failing_rows)."""
    return reduce(DataFrame.unionByName, reports(table, df, rules, parents))


def reports(
    table: str, df: DataFrame, rules: Sequence[Any], parents: Mapping[str, DataFrame] | None = None
) -> list[DataFrame]:
    """The report in the parts that are worked out on their own: one pass for all row rules,
    and one for every other rule."""
    parts = []
    row_rules = [r for r in rules if isinstance(r, RowRule)]
    if row_rules:
        parts.append(check_rows(table, df, row_rules))
    for rule in rules:
        if isinstance(rule, Unique):
            parts.append(_line(duplicated_keys(df, rule.column), table, rule, F.count("*")))
        elif isinstance(rule, Related):
            missing = orphan_counts(
                df, rule.column, (parents or {})[rule.parent], rule.parent_column
            )
            parts.append(_line(missing, table, rule, F.coalesce(F.sum("n"), F.lit(0))))
    return parts


def check_all(
    tables: Mapping[str, DataFrame],
    rules: Mapping[str, Sequence[Any]],
    parents: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    found = parents or tables
    return reduce(
        DataFrame.unionByName, [check(name, tables[name], rules[name], found) for name in rules]
    )
