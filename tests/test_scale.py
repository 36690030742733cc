"""What keeps the queries' jobs whole and in proportion to their input."""

import os
from datetime import timedelta
from threading import Barrier

from pyspark.sql import functions as F

from groupledger import queries
from groupledger.functions.keys import packed, unpacked
from groupledger.operators.incremental import latest_per_key, replace_by_key
from groupledger.operators import quality as queries_quality
from groupledger.operators.joins import ordered_pairs
from groupledger.plans.warehouse import Settings, Warehouse
from groupledger.session import FREED, shuffles_freed
from groupledger.sources import csv_landing, snapshots, tables, testtables
from groupledger.sources.registry import LANDING
from groupledger.sources.tables import create_keyed_table, merge_table, read_keyed_table

from .conftest import SMALL, as_list


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_joined_once_and_the_fact_is_not_copied(spark, tmp_path):
    store = str(tmp_path)
    raw = testtables.bronze(spark, SMALL, store)
    for name in ("raw_sub_a_sales", "raw_sub_b_shipments", "raw_sub_d_orders", "raw_sub_e_leases",
                 "raw_sub_c_loans"):
        assert "Join" not in plan(raw[name])
    settings = Settings(testtables.CALENDAR_START, testtables.CALENDAR_END, testtables.AS_OF)
    warehouse = Warehouse(spark, raw, testtables.fx_quotes(spark, SMALL), settings, store)
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").count()
    orders = spark.read.parquet(f"{SMALL}/orders.parquet").count()
    assert warehouse.transactions.count() == 4 * lines + orders
    assert sorted(p.name for p in tmp_path.glob("*/*")) == ["fx_rates", "lines", "orders"]


def test_rates_cover_the_calendar():
    settings = Settings(
        testtables.CALENDAR_START, testtables.CALENDAR_END, testtables.AS_OF, testtables.RATES_END
    )
    assert settings.quoted_until - timedelta(days=1) == testtables.CALENDAR_END - timedelta(days=1)


def test_pairs_of_small_keys_shuffle_their_rows_once(spark):
    """without a crowded key no grid is laid out, and both sides share one shuffle."""
    df = spark.range(2000).selectExpr("id % 700 AS k", "concat('S', id % 3) AS s", "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        pairs = ordered_pairs(df, ["k"], "s", "id", ("l_", "r_"))
        assert len(pairs.collect()) == 1900
        ran = pairs._jdf.queryExecution().executedPlan().executedPlan().toString()
        assert "ReusedExchange" in ran and "_a_cell" not in ran
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_and_orders_join_alike_at_every_size(spark):
    """Orders that are small enough are not broadcast either."""
    raw = testtables.bronze(spark, SMALL)
    ran = raw.lines._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [l_orderkey" in ran


def test_the_spend_fact_keeps_all_rows_but_only_columns_in_use(spark, monkeypatch):
    """keys and texts that the totals do not need are not stored and merged."""
    stored = []

    def create(df, path, *rest):
        stored.append(df.columns)
        create_keyed_table(df, path, *rest)

    monkeypatch.setattr(queries, "create_keyed_table", create)
    totals = queries.touched_period_spend(spark, SMALL)
    assert totals.count() == queries.QUERIES["mart_cost_center_spend"](spark, SMALL).count() > 0
    assert set(stored[0]) == {
        "subsidiary_code", "transaction_key", "product_key", "transaction_date",
        "gl_account_code", "amount_php", "_loaded_at", "_month",
    }


def test_packed_keys_stay_different(rows):
    """half the bytes of a hash key, and no two keys are taken for one."""
    keys = ["0a", "0A", "a", "00a", "", "\n", "zz", "d41d8cd98f00b204e9800998ecf8427e"]
    df = rows("k string", *[(k,) for k in keys], (None,)).select("k", packed("k").alias("p"))
    assert df.select("p").distinct().count() == len(keys) + 1
    assert df.filter("p IS NULL").count() == 1
    assert df.filter("length(p.digits) = 16 AND p.text IS NULL").count() == 1


def test_stored_files_are_zstd_whatever_the_session_says(spark, rows, tmp_path):
    """a session's default codec takes a third more bytes."""
    codec = spark.conf.get("spark.sql.parquet.compression.codec")
    spark.conf.set("spark.sql.parquet.compression.codec", "snappy")
    try:
        create_keyed_table(rows("k int, t int", (1, 1)), str(tmp_path), ["k"], ["t"])
    finally:
        spark.conf.set("spark.sql.parquet.compression.codec", codec)
    files = [p.name for p in tmp_path.rglob("*.parquet")]
    assert len(files) == 2 and all(name.endswith(".zstd.parquet") for name in files)


def test_landing_files_are_loaded_side_by_side(spark, tmp_path, monkeypatch):
    """a load does not wait for the last task of the one before."""
    raw, files = testtables.bronze(spark, SMALL), (LANDING[1], LANDING[3])
    for file in files:
        csv_landing.write_landing(raw[file.table].select(*file.schema.names), f"{tmp_path}/in/{file.path}")
    both, write = Barrier(2), csv_landing.write_table
    monkeypatch.setattr(
        csv_landing, "write_table", lambda *a, **k: (both.wait(60), write(*a, **k))[1])
    got = csv_landing.load_all(spark, f"{tmp_path}/in", f"{tmp_path}/out", files)
    assert [got[f.table].count() for f in files] == [raw[f.table].count() for f in files]
    assert list(got) == [f.table for f in files]


def test_a_merge_into_buckets_shuffles_rows_once(spark, rows, tmp_path):
    """not for the join by key and for the layout; empty keys and all others stay as they were."""
    ddl = "a int, b string, v int"
    old = rows(ddl, *[(i, "x", 0) for i in range(60)], (None, "x", 1), (None, "x", 2), (7, None, 3))
    fresh = rows(ddl, *[(i, "x", 9) for i in range(50, 70)], (None, "x", 9), (7, None, 9), (8, "y", 9))
    got = tables._replaced_in_buckets(old, fresh, ["a", "b"], 5)
    assert got.columns == ["a", "b", "v", tables.BUCKET]

    def plain(df):
        return sorted(map(repr, df.select("a", "b", "v").collect()))

    assert plain(got) == plain(replace_by_key(old, fresh, ["a", "b"]))
    assert got._jdf.queryExecution().executedPlan().executedPlan().toString().count("Exchange") == 1


def test_sales_are_joined_with_columns_in_use_only(spark, monkeypatch):
    """the upsert does not have all order lines stored with all their columns."""
    def refused(*_):
        raise AssertionError("joined lines")

    monkeypatch.setattr(queries, "warehouse", refused)
    sales = queries._sales(spark, SMALL)
    assert "Join" not in plan(sales) and len(sales.columns) == 5
    assert sales.count() == spark.read.parquet(f"{SMALL}/lineitem.parquet").count()


def test_a_batch_opens_only_its_buckets_keys(spark, rows, tmp_path):
    """a list of a table in buckets has one page, and is still searched by bucket."""
    path, ddl = str(tmp_path), "k int, t int"
    create_keyed_table(rows(ddl, *[(i, 1) for i in range(400)]), path, ["k"], ["t"], target_rows=20)
    first = snapshots.current(spark, path)
    assert first.buckets == 20 and set(first.pages.values()) == {1}
    new = merge_table(spark, path, rows(ddl, (5, 2), (900, 2)), ["k"], ["t"], "r1")
    assert sum(u.rows for u in new.opened) < 60
    got = as_list(read_keyed_table(spark, path, rows(ddl).schema))
    assert got == sorted([(i, 2 if i == 5 else 1) for i in range(400)] + [(900, 2)])


def test_suppliers_are_joined_by_the_size_of_their_file(spark):
    """a join with their nation before, whose size Spark overrates, shuffled all lines once more."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(limit, "64KB")
    try:
        ran = testtables.bronze(spark, SMALL).lines._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [l_orderkey" in ran and "SortMergeJoin [l_suppkey" not in ran
    finally:
        spark.conf.unset(limit)


def test_a_stored_write_leaves_no_shuffle_files(spark, tmp_path):
    """They took as much disk again as the tables until the driver collected garbage."""
    def shuffled():
        return sum(
            os.path.getsize(f"{folder}/{name}")
            for top in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
            .diskBlockManager().localDirsString()
            for folder, _, names in os.walk(top) for name in names if name.startswith("shuffle_")
        )

    rows = spark.range(200_000).selectExpr("id", "md5(string(id)) AS k").repartition(4, "k")
    before = shuffled()
    snapshots.write_rows(rows, str(tmp_path))
    assert shuffled() - before < 100_000
    assert spark.conf.get(FREED, None) is None


def test_blocks_that_free_shuffles_may_overlap(spark):
    first, second = shuffles_freed(spark), shuffles_freed(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(FREED) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(FREED, None) is None


def test_unpacked_keys_are_the_same_text(rows):
    keys = ["0a", "0A", "a", "", "zz", "d41d8cd98f00b204e9800998ecf8427e", None]
    df = rows("k string", *[(k,) for k in keys]).select("k", packed("k").alias("p"))
    assert df.filter(~F.col("k").eqNullSafe(unpacked("p"))).count() == 0


def test_only_rows_of_keys_that_repeat_are_grouped(spark, rows, tmp_path, monkeypatch):
    """all rows were shuffled to find the latest of their key."""
    ddl = "a int, b string, t int, v string"
    plain = [(i, "x", 1, "v") for i in range(30)]
    again = [(1, "x", 2, "w"), (None, "x", 1, "p"), (None, "x", 1, "q"), (2, None, 1, "v"), (2, None, 0, "z")]
    grouped = []
    monkeypatch.setattr(
        tables, "latest_per_key", lambda df, *a: (grouped.append(df.count()), latest_per_key(df, *a))[1])
    for number, (data, moved) in enumerate([(plain, []), (plain + again, [6])]):
        df = rows(ddl, *data)
        got = tables.one_per_key(df, ["a", "b"], ["t"], f"{tmp_path}/{number}")
        assert got.columns == df.columns and grouped == moved
        want = latest_per_key(df, ["a", "b"], ["t"])
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    monkeypatch.setattr(tables, "BROADCAST_ROWS", 0)
    got = tables.one_per_key(df, ["a", "b"], ["t"], f"{tmp_path}/many")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_a_merge_of_new_keys_writes_them_once(spark, rows, tmp_path, monkeypatch):
    """they were stored aside, joined with nothing and written again."""
    path, ddl, writes, write = str(tmp_path), "k int, p int, t int", [], snapshots.write_rows
    create_keyed_table(rows(ddl, (1, 1, 1), (2, 2, 1)), path, ["k"], ["t"], ["p"])
    monkeypatch.setattr(snapshots, "write_rows", lambda *a: (writes.append(a[1]), write(*a))[1])
    merge_table(spark, path, rows(ddl, (3, 1, 1), (4, 3, 1), (4, 2, 0)), ["k"], ["t"], "r1")
    assert len(writes) == 1
    merge_table(spark, path, rows(ddl, (3, 2, 2), (5, 3, 1)), ["k"], ["t"], "r2")
    got = as_list(read_keyed_table(spark, path, rows(ddl).schema))
    assert got == [(1, 1, 1), (2, 2, 1), (3, 2, 2), (4, 3, 1), (5, 3, 1)]
    kept = {f"_w={u.write}" for u in snapshots.current(spark, path).units}
    assert {p.name for p in tmp_path.glob("data/*") if any(p.iterdir())} >= kept
    assert len(writes) == 3 and not list(tmp_path.glob("work/*"))


def test_product_versions_are_told_by_one_column(spark):
    """their cost centre was shuffled beside the category that it is made of."""
    staged = queries.warehouse(spark, SMALL).staged("SUB_A")
    ran = queries.entities.products({"SUB_A": staged})._jdf.queryExecution().executedPlan().toString()
    first = [line for line in ran.splitlines() if "Exchange" in line][-1]
    assert "category" in first or "p_type" in first
    assert "cost_center" not in first


def test_parts_of_a_report_are_stored_one_after_another(spark, monkeypatch):
    """one job over all marts kept what all of them shuffled until its end."""
    stored, write = [], queries.write_table
    monkeypatch.setattr(queries, "write_table", lambda df, path: (stored.append(path), write(df, path))[1])
    chosen = {n: queries.rules.MART_RULES[n] for n in ("mart_customer_360", "mart_cash_collection")}
    monkeypatch.setattr(queries.rules, "MART_RULES", chosen)
    got = queries.dq_marts(spark, SMALL)
    assert len(stored) == 3 and len(set(stored)) == 3  # row rules of both, and one key
    w = queries.warehouse(spark, SMALL)
    want = queries.check_all({n: getattr(w, n)() for n in chosen}, chosen)
    assert as_list(got) == as_list(want) and got.count() == sum(map(len, chosen.values()))


def test_hash_keys_are_counted_packed(spark, rows):
    """half the bytes; the keys come back as they were."""
    df = rows("a_key string, a string", ("0a", "0a"), ("0a", "0a"), ("x", "x"), ("x", "x"), ("0A", "0A"), (None, None))
    for column in df.columns:
        assert as_list(queries_quality.duplicated_keys(df, column)) == [("0a", 2), ("x", 2)]
    assert "unhex" in plan(queries_quality.duplicated_keys(df, "a_key"))


def test_landing_files_go_when_their_tables_are_stored(spark, monkeypatch):
    """they took disk until the end, beside all raw tables."""
    seen, root, write = [], [], csv_landing.write_landing

    def written(df, path):
        top = path.split("/landing/")[0]
        root.append(top)
        seen.append({os.path.relpath(f, f"{top}/landing") for f, _, n in os.walk(f"{top}/landing") if n})
        write(df, path)

    monkeypatch.setattr(csv_landing, "write_landing", written)
    got = queries.bronze_load(spark, SMALL)
    assert got.count() == 6 and len(set(root)) == 1 and len(seen) == 6
    assert all(len(files) <= 1 for files in seen)  # two deliveries at a time
    assert not [n for _, _, names in os.walk(f"{root[0]}/landing") for n in names if n.endswith(".gz")]
