"""Marks, upserts, schema evolution, stored tables, streaming."""

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from pyspark.sql import functions as F

from groupledger.operators import control, incremental
from groupledger.operators.calendar import calendar
from groupledger.operators.fx import prepare_rates, to_home_currency
from groupledger.operators.joins import absent, insert_if_absent
from groupledger.plans.refresh import refresh_periods
from groupledger.sources import snapshots
from groupledger.sources.reference_rows import ingestion_config
from groupledger.sources.tables import (
    create_keyed_table, exists, layer, merge_table, read_keyed_table, read_table, table_path,
    write_table,
)
from groupledger.streaming.available_now import upsert_available

from .conftest import as_list, as_set, at, day

KEYED = "k int, v string, t int"
FEW = settings(
    max_examples=8, deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def test_marks_and_late_rows(rows):
    ddl = "s string, t timestamp_ntz"
    target = rows(ddl, ("A", at("2024-01-02 00:00:00")), ("A", at("2024-01-01 00:00:00")))
    marks = incremental.high_water_marks(target, ["A", "B"], "s", "t")
    assert marks == {"A": at("2024-01-02 00:00:00"), "B": incremental.FIRST_LOAD}
    batch = rows(ddl, ("A", at("2024-01-02 00:00:00")), ("A", at("2024-01-03 00:00:00")),
                 ("B", at("1999-01-01 00:00:00")))
    fresh = {("A", at("2024-01-03 00:00:00")), ("B", at("1999-01-01 00:00:00"))}
    assert as_set(incremental.newer_than_target_by_source(batch, target, "t", "s", ["A", "B"])) == fresh
    assert as_set(incremental.newer_than_target(batch, target, "t")) == {
        ("A", at("2024-01-03 00:00:00"))}
    assert incremental.high_water_marks(None, ["A"], "s", "t") == {"A": incremental.FIRST_LOAD}


def test_global_mark_of_an_empty_target(rows):
    batch = rows("t timestamp_ntz", (at("2024-01-02 00:00:00"),))
    assert incremental.newer_than_target(batch, batch.limit(0), "t").count() == 1


def test_duplicate_keys_in_a_batch_take_the_latest(rows):
    batch = rows(KEYED, (1, "a", 1), (1, "b", 2), (1, "c", 2), (2, "x", 1))
    assert as_list(incremental.latest_per_key(batch, ["k"], ["t"])) == [(1, "c", 2), (2, "x", 1)]


row = st.tuples(st.integers(0, 6), st.sampled_from("abc"), st.integers(0, 5))


@FEW
@given(target=st.lists(row, max_size=8), batch=st.lists(row, max_size=8))
def test_upsert_matches_a_dictionary_and_is_idempotent(rows, target, batch):
    old = {k: (k, v, t) for k, v, t in target}
    new = {}
    for k, v, t in sorted(batch, key=lambda r: (r[2], r[1])):
        new[k] = (k, v, t)
    before, change = rows(KEYED, *old.values()), rows(KEYED, *batch)
    once = incremental.upsert(before, change, ["k"], ["t"])
    assert as_list(once) == sorted({**old, **new}.values())
    assert as_list(incremental.upsert(once, change, ["k"], ["t"])) == as_list(once)


def test_insert_if_absent_keeps_matched_rows(rows):
    target, source = rows("k int, v string", (1, "old")), rows("k int, v string", (1, "new"), (2, "b"))
    assert as_list(insert_if_absent(target, source, ["k"])) == [(1, "old"), (2, "b")]
    assert as_list(absent(source, target, ["k"])) == [(2, "b")]


def test_schema_changes(rows):
    target, batch = rows("k int, y string", (1, "y")), rows("k int, x string", (2, "x"))
    synced = incremental.sync_all_columns(target, batch)
    assert synced.columns == ["k", "x"] and as_list(synced) == [(1, None)]
    wide, fresh = incremental.append_new_columns(target, batch)
    assert wide.columns == fresh.columns == ["k", "y", "x"]
    assert as_set(wide.unionByName(fresh)) == {(1, "y", None), (2, None, "x")}


def test_merge_rewrites_and_repeats(spark, rows, tmp_path):
    path, keys, order = str(tmp_path / "t"), ["k"], ["t"]
    create_keyed_table(rows(KEYED, *[(i, "old", 1) for i in range(50)]), path, keys, order)
    schema = rows(KEYED, (0, "", 0)).schema
    batch = rows(KEYED, (3, "new", 2), (99, "new", 2))
    merge_table(spark, path, batch, keys, order, "r1")
    merged = as_list(read_keyed_table(spark, path, schema))
    assert len(merged) == 51 and (3, "new", 2) in merged and (99, "new", 2) in merged
    merge_table(spark, path, batch, keys, order, "r1")
    assert as_list(read_keyed_table(spark, path, schema)) == merged


def test_merge_with_a_changed_layout(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    create_keyed_table(rows("k int, y string", (1, "y"), (2, "y")), path, ["k"], ["y"])
    batch = rows("k int, x string", (2, "x"))
    merge_table(spark, path, batch, ["k"], ["x"], "r1")
    assert as_set(read_keyed_table(spark, path, batch.schema)) == {(1, None), (2, "x")}


def test_key_moves_to_another_partition(spark, rows, tmp_path):
    path, keys, order = str(tmp_path / "t"), ["k"], ["t"]
    ddl = "k int, m date, t int"
    a, b, c = day("2024-01-01"), day("2024-02-01"), day("2024-03-01")
    start = rows(ddl, (1, a, 1), (2, b, 1), (3, b, 1), (4, c, 1), (5, None, 1))
    create_keyed_table(start, path, keys, order, ["m"])
    before = snapshots.current(spark, path)
    march = [u for u in before.units if u.folder == "m=2024-03-01"]
    for _ in range(2):  # the second time as a repeated run
        merge_table(spark, path, rows(ddl, (1, b, 2), (5, a, 2), (6, b, 2), (6, b, 1)), keys, order, "r1")
        got = read_keyed_table(spark, path, start.schema)
        assert as_set(got) == {(1, b, 2), (2, b, 1), (3, b, 1), (4, c, 1), (5, a, 2), (6, b, 2)}
    merge_table(spark, path, rows(ddl, (5, b, 3)), keys, order, "r2")
    assert as_set(read_keyed_table(spark, path, start.schema)) == {
        (1, b, 2), (2, b, 1), (3, b, 1), (4, c, 1), (5, b, 3), (6, b, 2)}
    now = snapshots.current(spark, path)
    assert {u.folder for u in now.units} == {"m=2024-02-01", "m=2024-03-01"}
    assert [u for u in now.units if u.folder == "m=2024-03-01"] == march  # never rewritten


def test_reused_run_id_loses_no_row(spark, rows, tmp_path):
    path, keys, order = str(tmp_path / "t"), ["k"], ["t"]
    start = rows(KEYED, (1, "old", 1), (2, "old", 1))
    create_keyed_table(start, path, keys, order)
    merge_table(spark, path, rows(KEYED, (1, "new", 2)), keys, order, "day1")
    merge_table(spark, path, rows(KEYED, (2, "new", 3)), keys, order, "day2")
    merge_table(spark, path, rows(KEYED, (9, "new", 4)), keys, order, "day1")
    merge_table(spark, path, rows(KEYED, (8, "new", 4)), keys, order, "day1")
    assert as_list(read_keyed_table(spark, path, start.schema)) == [
        (1, "new", 2), (2, "new", 3), (8, "new", 4), (9, "new", 4)]


def test_new_table_forgets_merges_into_the_old_one(spark, rows, tmp_path):
    path, keys, order = str(tmp_path / "t"), ["k"], ["t"]
    create_keyed_table(rows(KEYED, (1, "a", 1)), path, keys, order)
    merge_table(spark, path, rows(KEYED, (2, "b", 1)), keys, order, "r1")
    create_keyed_table(rows(KEYED, (5, "c", 1)), path, keys, order)
    merge_table(spark, path, rows(KEYED, (6, "d", 1)), keys, order, "r1")
    assert as_list(read_keyed_table(spark, path, rows(KEYED).schema)) == [(5, "c", 1), (6, "d", 1)]


def test_keep_latest_across_batches_and_partitions(spark, rows, tmp_path):
    path, ddl = str(tmp_path / "t"), "k int, p int, t int"
    create_keyed_table(rows(ddl, (1, 0, 9), (2, 0, 1)), path, ["k"], ["t"], ["p"])
    late = rows(ddl, (1, 1, 2), (2, 1, 2), (3, 1, 1))
    merge_table(spark, path, late, ["k"], ["t"], "r1", keep_latest=True)
    assert as_set(read_keyed_table(spark, path, late.schema)) == {(1, 0, 9), (2, 1, 2), (3, 1, 1)}


def test_odd_partition_values_are_refused(spark, rows, tmp_path):
    path, ddl = str(tmp_path / "t"), "k int, p string"
    create_keyed_table(rows(ddl, (1, "a")), path, ["k"], ["p"], ["p"])
    with pytest.raises(ValueError):
        merge_table(spark, path, rows(ddl, (1, "b/c")), ["k"], ["p"], "r1")


def test_layers(spark, rows, tmp_path):
    assert layer(None, "target") == "target" and layer(" marts ") == "marts"
    path = table_path(str(tmp_path), "marts", "m")
    assert not exists(spark, path)
    stored = write_table(rows("p int, v int", (1, 2), (2, 3)), path, ["p"])
    assert exists(spark, path) and stored.columns == ["p", "v"]
    write_table(rows("p int, v int", (5, 6)), path, ["p"])
    assert as_list(read_table(spark, path)) == [(5, 6)]
    assert as_list(stored) == [(1, 2), (2, 3)]  # opened before


def test_control_table(spark, rows):
    marks = {"raw_sub_a_sales": at("2024-01-02 00:00:00")}
    config = ingestion_config(spark, marks).filter("subsidiary_code = 'SUB_A'")
    ddl = "updated_at timestamp_ntz, _subsidiary_code string"
    late = at("2024-01-09 00:00:00")
    times = control.load_times({
        "raw_sub_a_sales": (rows(ddl, (at("2024-01-02 00:00:00"), "SUB_A"), (at("2024-01-03 00:00:00"), "SUB_A"),
                                 (late, "SUB_B"), (late, None)), "updated_at"),
        "raw_sub_a_customers": (rows(ddl, (None, "SUB_A"), (None, "SUB_A"), (None, "SUB_A"), (None, "SUB_C")), None),
    })
    counts = control.new_row_counts(config, times)
    assert as_set(counts.select("target_table", "new_rows")) == {
        ("raw_sub_a_sales", 1), ("raw_sub_a_customers", 3)}
    moved = control.advance_marks(config, times, at("2025-01-01 00:00:00"))
    assert as_set(moved.select("target_table", "last_loaded_at")) == {
        ("raw_sub_a_sales", at("2024-01-03 00:00:00")),
        ("raw_sub_a_customers", at("2025-01-01 00:00:00"))}


@pytest.mark.parametrize("hours,status", [(24, "pass"), (25, "pass"), (26, "warn"), (49, "warn"),
                                          (50, "error")])
def test_freshness(rows, hours, status):
    times = rows("target_table string, loaded timestamp_ntz", ("x", at("2024-01-01 00:00:00")))
    now = at(f"2024-01-0{1 + hours // 24} {hours % 24:02d}:00:00")
    assert control.freshness(times, now).first().status == status


def test_rates_are_intervals_between_quotes(rows):
    """A quote before the start holds there, the last one to the end, later ones play no part."""
    ddl = "rate_date date, `USDPHP=X` decimal(18,6), `EURPHP=X` decimal(18,6)"
    quotes = rows(ddl, (day("2023-12-30"), Decimal("50"), None), (day("2024-01-03"), Decimal("40"), None),
                  (day("2024-01-05"), Decimal("10"), Decimal("2")), (day("2024-01-03"), None, Decimal("8")))
    tickers = {"USDPHP=X": "USD", "EURPHP=X": "EUR"}
    got = prepare_rates(quotes, day("2024-01-01"), day("2024-01-05"), tickers)
    assert {(r.from_currency, r.rate_date.day, int(r.usd_php_rate)) for r in got.collect()} == {
        ("USD", 1, 50), ("USD", 2, 50), ("USD", 3, 40), ("USD", 4, 40),
        ("EUR", 1, 8), ("EUR", 2, 8), ("EUR", 3, 8), ("EUR", 4, 8)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "unboundedfollowing" not in plan.lower()
    early = prepare_rates(quotes, day("2024-01-01"), day("2024-01-03"), tickers)
    assert {(r.from_currency, r.rate) for r in early.collect()} == {("USD", Decimal("0.02")), ("EUR", None)}
    assert prepare_rates(quotes, day("2023-01-01"), day("2023-01-05"), tickers).count() == 0


def test_amounts_that_do_not_fit_fail(rows):
    facts = rows("transaction_date date, currency_code string, amount_local decimal(15,2)",
                 (day("2024-01-01"), "USD", Decimal("9999999999999.99")))
    rates = rows("rate_date date, from_currency string, rate decimal(18,8)",
                 (day("2024-01-01"), "USD", Decimal("0.00000001")))
    with pytest.raises(Exception, match="(?i)overflow|out of range|cannot be represented"):
        to_home_currency(facts, rates, 1).collect()


def test_rates_fill_gaps_both_ways(rows):
    quotes = rows("rate_date date, `USDPHP=X` decimal(18,6), `EURPHP=X` decimal(18,6)",
                  (day("2024-01-02"), Decimal("50"), None), (day("2024-01-04"), None, Decimal("4")))
    got = prepare_rates(quotes, day("2024-01-01"), day("2024-01-06"),
                        {"USDPHP=X": "USD", "EURPHP=X": "EUR"})
    assert got.count() == 10
    assert {(r.from_currency, r.rate, r.to_currency) for r in got.collect()} == {
        ("USD", Decimal("0.02000000"), "PHP"), ("EUR", Decimal("0.25000000"), "PHP")}


@FEW
@given(quoted=st.lists(st.tuples(st.integers(0, 9), st.sampled_from([0, 1])), min_size=1,
                       unique=True, max_size=6))
def test_rates_are_dense(rows, quoted):
    names = ["USDPHP=X", "EURPHP=X"]
    data = {}
    for offset, which in quoted:
        data.setdefault(offset, [None, None])[which] = Decimal(offset + 1)
    quotes = rows("rate_date date, `USDPHP=X` decimal(18,6), `EURPHP=X` decimal(18,6)",
                  *[(day(f"2024-01-{d + 1:02d}"), *v) for d, v in data.items()])
    got = prepare_rates(quotes, day("2024-01-01"), day("2024-01-11"), dict(zip(names, ["USD", "EUR"])))
    assert got.count() == 2 * 10


def test_stream_takes_each_file_once_and_late_rows(spark, rows, tmp_path):
    source, target, mark = (str(tmp_path / n) for n in ("in", "table", "check"))
    schema = rows(KEYED, (0, "", 0)).schema

    def arrive(*data):
        rows(KEYED, *data).coalesce(1).write.mode("append").parquet(source)

    def run():
        upsert_available(spark, source, schema, target, mark, ["k"], ["t"], target_rows=2)
        return as_list(read_keyed_table(spark, target, schema))

    arrive((1, "a", 5), (2, "a", 5))
    assert run() == [(1, "a", 5), (2, "a", 5)]
    assert run() == [(1, "a", 5), (2, "a", 5)]
    arrive((3, "late", 1), (2, "b", 6))
    assert run() == [(1, "a", 5), (2, "b", 6), (3, "late", 1)]


def test_stream_keeps_later_versions_and_outlives_its_checkpoint(spark, rows, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "table")
    schema = rows(KEYED, (0, "", 0)).schema

    def arrive(mark, *data):
        rows(KEYED, *data).coalesce(1).write.mode("append").parquet(source)
        upsert_available(spark, source, schema, target, str(tmp_path / mark), ["k"], ["t"], target_rows=2)
        return as_list(read_keyed_table(spark, target, schema))

    assert arrive("a", (1, "new", 9)) == [(1, "new", 9)]
    assert arrive("a", (1, "older", 2), (7, "x", 1)) == [(1, "new", 9), (7, "x", 1)]
    assert arrive("b", (8, "y", 1)) == [(1, "new", 9), (7, "x", 1), (8, "y", 1)]
    assert arrive("b", (9, "z", 1)) == [(1, "new", 9), (7, "x", 1), (8, "y", 1), (9, "z", 1)]


def test_emptied_month_goes(spark, rows, tmp_path):
    path, cal = str(tmp_path / "mart"), calendar(spark, day("2024-01-01"), day("2024-05-01"))
    months = rows("month date", (day("2024-02-01"),), (day("2024-03-01"),))

    def build(df, period):
        joined = df.join(period, df.transaction_date == period.date_key)
        return joined.groupBy("year", "month_num").agg(F.sum("v").alias("total"))

    def run(only, *data):
        source = rows("transaction_date date, v int", *data)
        got = refresh_periods(spark, path, source, cal, build, at("2024-06-01 00:00:00"), only)
        return as_set(got.select("month_num", "total"))

    january = (day("2024-01-05"), 1)
    assert run(None, january, (day("2024-02-05"), 2)) == {(1, 1), (2, 2)}
    assert run(months, january, (day("2024-03-05"), 2)) == {(1, 1), (3, 2)}
    assert run(months, january) == {(1, 1)}


def test_refreshed_months_may_bring_a_new_column(spark, rows, tmp_path):
    path = str(tmp_path / "mart")
    cal = calendar(spark, day("2024-01-01"), day("2024-04-01"))
    source = rows("transaction_date date, v int", (day("2024-01-05"), 1), (day("2024-02-05"), 2),
                  (day("2024-02-06"), 3))
    months = rows("month date", (day("2024-02-01"),))

    def build(with_top):
        def make(df, period):
            joined = df.join(period, df.transaction_date == period.date_key)
            aggs = [F.sum("v").alias("total")] + ([F.max("v").alias("top")] if with_top else [])
            return joined.groupBy("year", "month_num").agg(*aggs)
        return make

    def run(with_top, only):
        got = refresh_periods(spark, path, source, cal, build(with_top), at("2024-05-01 00:00:00"), only)
        return as_set(got.select("month_num", "total", *(["top"] if "top" in got.columns else [])))

    assert run(False, None) == {(1, 1), (2, 5)}
    assert run(True, months) == {(1, 1, None), (2, 5, 3)}
    assert run(False, months) == {(1, 1, None), (2, 5, None)}
