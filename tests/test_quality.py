"""Every kind of rule with passing and failing rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from groupledger.operators.quality import (
    Accepted, Between, HasType, Holds, NotNull, Related, Unique, check, duplicated_keys,
    offending_rows, orphan_counts,
)
from groupledger.plans import quality_rules
from groupledger.sources.reference_rows import gl_mapping, subsidiaries

from .conftest import as_list, day


@pytest.fixture
def table(rows):
    return rows("k int, s string, d date, q string",
                (1, "a", day("2024-01-01"), "005"), (1, "b", day("2025-01-01"), "011"),
                (2, None, None, "x"), (None, "c", day("2024-06-01"), None))


@pytest.mark.parametrize("rule,failing", [
    (NotNull("k"), 1),
    (NotNull("q"), 1),
    (Accepted("s", ("a", "b")), 1),
    (Accepted("s", ("a", "b", "c")), 0),
    (Between("k", 1, 1), 1),
    (Between("k", 1, 2), 0),
    (Between("d", day("2024-01-01"), day("2024-12-31")), 1),
    (Between("q", 0, 10), 1),
    (Unique("k"), 1),
    (Unique("s"), 0),
    (HasType("d", "date"), 0),
    (HasType("s", "date"), 4),
    (Related("k", "parent", "id"), 1),
])
def test_rule(rows, table, rule, failing):
    parent = rows("id int", (1,), (1,))
    got = as_list(check("t", table, [rule], {"parent": parent}))
    assert got == [("t", rule.column, rule.rule, failing)]


def test_condition_between_columns(table):
    rule = Holds("k", F.col("k") == 1)
    assert as_list(check("t", table, [rule])) == [("t", "k", "reconciles", 1)]


def test_many_rules_in_one_report(table):
    report = check("t", table, [NotNull("k"), NotNull("s"), Unique("k"), Between("k", 0, 1)])
    assert report.count() == 4


def test_looking_at_offenders(rows, table):
    assert offending_rows(table, NotNull("k")).count() == 1
    assert as_list(duplicated_keys(table, "k")) == [(1, 2)]
    assert as_list(orphan_counts(table, "k", rows("id int", (1,)), "id")) == [(2, 1)]


def test_missing_subsidiaries(spark, rows):
    pnl = rows("subsidiary_code string", ("SUB_A",), ("SUB_B",))
    got = quality_rules.missing_subsidiaries(subsidiaries(spark), pnl)
    assert as_list(got) == [("SUB_D", "ManufactureCo")]


def test_unbalanced_pairs(rows):
    d = Decimal
    ddl = ("interco_amount_php decimal(18,2), seller_amount_php decimal(18,2), "
           "buyer_amount_php decimal(18,2), elimination_debit_php decimal(18,2), "
           "elimination_credit_php decimal(18,2), amount_difference decimal(19,2)")
    pairs = rows(ddl, (d(1), d(1), d(1), d(-1), d(1), d(0)), (d(1), d(1), d(2), d(-1), d(2), d(1)),
                 (None, None, d(1), None, d(1), None), (d(1), d(1), None, d(-1), None, None))
    assert quality_rules.unbalanced_pairs(pairs).count() == 3


def test_seeds_pass_their_rules(spark):
    rules = quality_rules.INTEGRATION_RULES
    for name, df in {"gl_account_mapping": gl_mapping(spark), "ent_subsidiary": subsidiaries(spark)}.items():
        assert {r.failing_rows for r in check(name, df, rules[name]).collect()} == {0}


def test_number_of_declared_rules():
    groups = (quality_rules.BRONZE_RULES, quality_rules.STAGING_RULES,
              quality_rules.INTEGRATION_RULES, quality_rules.MART_RULES)
    listed = [rule for group in groups for rules in group.values() for rule in rules]
    counts = {kind: sum(isinstance(r, kind) for r in listed)
              for kind in (NotNull, Unique, Accepted, Between, HasType, Related)}
    assert counts == {NotNull: 339, Unique: 18, Accepted: 42, Between: 44, HasType: 6, Related: 3}


def test_reconciliation_catches_a_wrong_row(rows):
    listed = quality_rules.reconciliation_rules(day("2024-01-01"))["raw_sub_e_leases"]
    ddl = ("start_date timestamp_ntz, end_date timestamp_ntz, term_years int, "
           "monthly_rent_php decimal(15,2), annual_rent_php decimal(15,2), "
           "security_deposit decimal(15,2), status string")
    from datetime import datetime
    good = (datetime(2023, 1, 1), datetime(2024, 1, 1), 1, Decimal(1), Decimal(12), Decimal(2), "EXPIRED")
    bad = (datetime(2023, 1, 1), datetime(2024, 1, 2), 1, Decimal(1), Decimal(13), Decimal(3), "EXPIRED")
    assert {r.failing_rows for r in check("raw_sub_e_leases", rows(ddl, good), listed).collect()} == {0}
    assert {r.failing_rows for r in check("raw_sub_e_leases", rows(ddl, bad), listed).collect()} == {1}
