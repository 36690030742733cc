"""Versions of stored tables, and merges that open only what they must."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from pyspark.sql import functions as F

from groupledger.operators.calendar import calendar
from groupledger.plans import refresh
from groupledger.sources import snapshots, tables
from groupledger.sources.tables import (
    append_rows, create_keyed_table, merge_table, publish, read_keyed_table, read_table, replace_partitions,
    write_table,
)

from .conftest import as_list, as_set, at, day

KEYED = "k int, v string, t int"
PARTED = "k int, p int, v string, t int"


def test_a_reader_keeps_its_version(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write_table(rows("p int, v int", (1, 2), (2, 3)), path, ["p"])
    opened = read_table(spark, path)
    files = set(opened.inputFiles())
    write_table(rows("p int, v int", (5, 6)), path, ["p"])
    replace_partitions(rows("p int, v int", (7, 8)), path, ["p"], rows("p int", (5,)))
    append_rows(rows("p int, v int", (7, 9)), path)
    assert as_list(opened) == [(1, 2), (2, 3)] and set(opened.inputFiles()) == files
    assert as_list(read_table(spark, path)) == [(7, 8), (7, 9)]
    snapshots.vacuum(spark, path, keep=1)
    assert as_list(read_table(spark, path)) == [(7, 8), (7, 9)]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2


def test_a_table_may_be_rewritten_from_itself(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write_table(rows("v int", (1,), (2,)), path)
    for _ in range(2):
        write_table(read_table(spark, path).select((F.col("v") * 10).alias("v")), path)
    assert as_list(read_table(spark, path)) == [(100,), (200,)]


def test_a_lost_write_changes_nothing(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    create_keyed_table(rows(KEYED, (1, "a", 1), (2, "a", 1)), path, ["k"], ["t"])

    def lost(*_):
        raise KeyboardInterrupt

    for step in ("_switch", "_write_text"):
        with monkeypatch.context() as cut, pytest.raises(KeyboardInterrupt):
            cut.setattr(snapshots, step, lost)
            merge_table(spark, path, rows(KEYED, (1, "b", 2)), ["k"], ["t"], "r1")
        assert as_list(read_table(spark, path).select("k", "v")) == [(1, "a"), (2, "a")]
    merge_table(spark, path, rows(KEYED, (1, "b", 2)), ["k"], ["t"], "r1")
    assert as_list(read_table(spark, path).select("k", "v")) == [(1, "b"), (2, "a")]
    snapshots.vacuum(spark, path, keep=1)
    assert as_list(read_table(spark, path).select("k", "v")) == [(1, "b"), (2, "a")]


def test_a_second_writer_is_noticed(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write_table(rows("v int", (1,)), path)
    stale = snapshots.current(spark, path)
    write_table(rows("v int", (2,)), path)
    with pytest.raises(RuntimeError, match="another writer"):
        snapshots.commit(spark, path, stale, stale)
    assert as_list(read_table(spark, path)) == [(2,)]


def test_a_merge_opens_only_units_with_its_keys(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "PAGE_ROWS", 50)  # several pages of key hashes
    path, keys, order = str(tmp_path / "t"), ["k"], ["t"]
    start = rows(PARTED, *[(i, i % 10, "old", 1) for i in range(400)])
    create_keyed_table(start, path, keys, order, ["p"])
    first = snapshots.current(spark, path)
    assert set(first.pages.values()) == {8}

    read = []
    plain = snapshots.read_units
    monkeypatch.setattr(snapshots, "read_units", lambda s, p, by, units, schema: (
        read.append({u.folder for u in units}), plain(s, p, by, units, schema))[1])
    batch = rows(PARTED, (3, 7, "moved", 2), (14, 4, "new", 2), (900, 8, "added", 2))
    new = merge_table(spark, path, batch, keys, order, "r1")
    assert {u.folder for u in new.opened} == read[0] == {"p=3", "p=4"}
    assert set(new.touched) == {"p=3", "p=4", "p=7", "p=8"}
    kept = {u for u in first.units if u.folder not in ("p=3", "p=4")}
    assert kept <= set(new.units)  # p=7 and p=8 only got files beside theirs
    got = as_set(read_keyed_table(spark, path, start.schema))
    want = {(i, i % 10, "old", 1) for i in range(400) if i not in (3, 14)}
    assert got == want | {(3, 7, "moved", 2), (14, 4, "new", 2), (900, 8, "added", 2)}


def test_only_pages_of_the_batch_are_read(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "PAGE_ROWS", 20)
    path = str(tmp_path / "t")
    create_keyed_table(rows(PARTED, *[(i, 0, "old", 1) for i in range(600)]), path, ["k"], ["t"], ["p"])
    merge_table(spark, path, rows(PARTED, (700, 1, "x", 1)), ["k"], ["t"], "r1")  # a write of one page
    of = snapshots.current(spark, path)
    assert sorted(of.pages.values()) == [1, 32]
    page = rows(PARTED, (5, 0, "x", 1)).select(tables._page(F.xxhash64("k"), 32)).first()[0]
    listed = tables._listed_keys(spark, path, of, [page])
    held = {(r[0], r[1]) for r in listed.select(snapshots.WRITE, tables.PAGE).distinct().collect()}
    assert held == {(w, page if pages == 32 else 0) for w, pages in of.pages.items()}
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "_page#" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert {u.folder for u in tables.units_with(spark, path, of, rows(PARTED, (5, 0, "x", 1)))} == {"p=0"}


def test_units_of_a_partition_are_joined(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "DELTAS", 3)
    path = str(tmp_path / "t")
    create_keyed_table(rows(PARTED, (0, 1, "a", 1), (1, 2, "a", 1)), path, ["k"], ["t"], ["p"])
    most = 0
    for i in range(2, 12):
        new = merge_table(spark, path, rows(PARTED, (i, 1, "a", 1)), ["k"], ["t"], f"r{i}")
        most = max(most, sum(u.folder == "p=1" for u in new.units))
    assert most == 3
    assert {r[0] for r in read_table(spark, path).select("k").collect()} == set(range(12))


def test_a_table_grows_by_splitting_buckets(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    create_keyed_table(rows(KEYED, *[(i, "a", 1) for i in range(40)]), path, ["k"], ["t"], target_rows=10)
    before = snapshots.current(spark, path)
    assert before.buckets == 4 and len(before.units) == 4
    new = merge_table(spark, path, rows(KEYED, *[(i, "b", 2) for i in range(40, 52)]), ["k"], ["t"], "r1")
    assert new.buckets == 6  # two of the four are split, the other two stay as they are
    assert {u.folder for u in new.opened} == {"_bucket=0", "_bucket=1"}
    assert {u for u in before.units if u.folder in ("_bucket=2", "_bucket=3")} <= set(new.units)
    assert as_set(read_keyed_table(spark, path, rows(KEYED).schema)) == {
        *((i, "a", 1) for i in range(40)), *((i, "b", 2) for i in range(40, 52))}
    again = merge_table(spark, path, rows(KEYED, (7, "c", 3), (50, "c", 3)), ["k"], ["t"], "r2")
    assert len(again.opened) <= 3
    assert read_table(spark, path).filter("v = 'c'").count() == 2 and read_table(spark, path).count() == 52


def test_buckets_split_by_linear_hashing(spark):
    def of(h, n):
        half = 1 << n.bit_length() - 1
        return h % (2 * half) if h % (2 * half) < n else h % (2 * half) - half

    rng = random.Random(1)
    for old in range(1, 20):
        for new in range(old, 45):
            moved = tables.split_from(old, new)
            for h in (rng.getrandbits(40) for _ in range(30)):
                assert of(h, old) == of(h, new) or of(h, old) in moved
    hashes = [(rng.getrandbits(63) - (1 << 62),) for _ in range(50)]
    df = spark.createDataFrame(hashes, "h long")
    for n in (1, 3, 8, 13):
        assert {(r.h, r.b) for r in df.select("h", tables.bucket(F.col("h"), n).alias("b")).collect()} == {
            (h, of(h, n)) for (h,) in hashes}


change = st.lists(st.tuples(st.integers(0, 12), st.integers(0, 2), st.sampled_from("abc"), st.integers(0, 9)), max_size=6)


@settings(max_examples=5, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(loads=st.lists(change, min_size=2, max_size=4), parted=st.booleans(), latest=st.booleans())
def test_merges_match_a_dictionary(spark, rows, tmp_path_factory, loads, parted, latest):
    path, state = str(tmp_path_factory.mktemp("m") / "t"), {}
    for number, load in enumerate(loads):
        df = rows(PARTED, *load)
        if number == 0:
            create_keyed_table(df, path, ["k"], ["t"], ["p"] if parted else [], target_rows=3)
        else:
            merge_table(spark, path, df, ["k"], ["t"], f"r{number}", keep_latest=latest)
        batch = {}
        for k, p, v, t in sorted(load, key=lambda r: (r[3], r[1], r[2])):
            batch[k] = (k, p, v, t)
        for k, row in batch.items():
            old = state.get(k)
            if not (latest and old and (old[3], old[1], old[2]) > (row[3], row[1], row[2])):
                state[k] = row
    got = read_keyed_table(spark, path, rows(PARTED).schema)
    assert as_list(got) == sorted(state.values())


def test_published_names_are_replaced_in_one_step(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    create_keyed_table(rows(PARTED, *[(i, i % 3, "a", 1) for i in range(9)]), path, ["k"], ["t"], ["p"])
    publish(spark, "snap_check.facts", path)
    merge_table(spark, path, rows("k int, p int, v string, t int, more int", (1, 1, "b", 2, 5)), ["k"], ["t"], "r1")
    assert spark.table("snap_check.facts").count() == 9 and spark.table("snap_check.facts").columns == ["k", "p", "v", "t"]
    publish(spark, "snap_check.facts", path)
    assert as_set(spark.sql("SELECT k, p, v, more FROM snap_check.facts WHERE p = 1")) == {
        (1, 1, "b", 5), (4, 1, "a", None), (7, 1, "a", None)}
    write_table(rows("x int"), path)
    publish(spark, "snap_check.facts", path)
    assert spark.table("snap_check.facts").columns == ["x"] and spark.table("snap_check.facts").count() == 0


def test_months_changed_since_a_mart_was_built(spark, rows, tmp_path):
    facts, mart = str(tmp_path / "facts"), str(tmp_path / "mart")
    ddl = "subsidiary_code string, transaction_key string, transaction_date date, v int, _loaded_at timestamp_ntz"
    cal = calendar(spark, day("2024-01-01"), day("2024-06-01"))

    def load(*data):
        batch = refresh.with_month(rows(ddl, *[(*row, at("2024-06-01 00:00:00")) for row in data]))
        refresh._store(spark, facts, batch, refresh.FACT_KEY, "same", refresh.FACT_LAYOUT)

    def build(df, period):
        joined = df.join(period, df.transaction_date == period.date_key)
        return joined.groupBy("year", "month_num").agg(F.sum("v").alias("total"))

    plans = []

    def refreshed():
        months = refresh.changed_months(spark, facts, mart)
        source = read_table(spark, facts)
        if months is not None:
            plans.append(refresh.in_months(source, months)._jdf.queryExecution().executedPlan().toString())
        refresh.refresh_periods(
            spark, mart, source, cal, build, at("2024-06-01 00:00:00"), months, refresh.built_from(spark, facts))
        return months, as_set(read_table(spark, mart).select("month_num", "total"))

    load(("A", "1", day("2024-01-05"), 1), ("B", "2", day("2024-02-05"), 2), ("A", "3", day("2024-04-05"), 4))
    assert refreshed() == (None, {(1, 1), (2, 2), (4, 4)})
    load(("A", "1", day("2024-03-05"), 10))  # the run dies before it refreshes the mart
    load(("A", "9", day("2024-01-09"), 5), ("B", "2", None, 0))
    assert refresh.changed_months(spark, facts, mart, "B") == [day("2024-02-01")]
    assert refreshed() == ([day("2024-01-01"), day("2024-02-01"), day("2024-03-01")], {(1, 5), (3, 10), (4, 4)})
    assert "PartitionFilters: [_month#" in plans[0] and "PartitionFilters: []" not in plans[0]
    assert refreshed()[0] == []


def test_months_are_ranges_on_other_tables(rows):
    df = rows("transaction_date date", *[(day(f"2024-{m:02d}-15"),) for m in range(1, 13)], (day("2025-01-01"),), (None,))
    months = [day("2024-12-01"), day("2024-02-01"), day("2024-03-01")]
    assert {r[0].month for r in refresh.in_months(df, months).collect()} == {2, 3, 12}
    assert refresh.in_months(df, []).count() == 0
