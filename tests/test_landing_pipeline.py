"""CSV landing files and the whole pipeline run."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from groupledger.plans import marts_business
from groupledger.plans.pipeline import load_mapping, run_pipeline
from groupledger.plans.warehouse import Settings
from groupledger.schemas import BRONZE, _layout
from groupledger.sources import csv_landing, snapshots, testtables
from groupledger.sources.reference_rows import gl_mapping
from groupledger.sources.registry import LANDING, LandingFile
from groupledger.sources.tables import ensure_databases, ensure_table, read_table

from .conftest import SMALL, as_list, as_set

SCHEMA = _layout("id string, note string, n integer, d date, t timestamp_ntz, b boolean")


def put(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(["other,header,names,than,the,layout", *lines]) + "\n")


def test_positions_nulls_and_quotes(spark, tmp_path):
    put(tmp_path, "f.csv", 'a,"x, ""y""",7,2024-01-02,2024-01-02T03:04:05,true',
        "b,NULL,null,,,false", 'c,"",NULL,NULL,null,')
    got = csv_landing.read_landing(spark, str(tmp_path / "f.csv"), SCHEMA)
    assert as_set(got) == {
        ("a", 'x, "y"', 7, datetime(2024, 1, 2).date(), datetime(2024, 1, 2, 3, 4, 5), True),
        ("b", None, None, None, None, False), ("c", None, None, None, None, None)}


def test_malformed_value_fails_or_is_null(spark, tmp_path):
    put(tmp_path, "f.csv", "a,x,08x,2024-13-02,2024-01-02 03:04,maybe")
    path = str(tmp_path / "f.csv")
    with pytest.raises(Exception):
        csv_landing.read_landing(spark, path, SCHEMA).collect()
    tolerant = csv_landing.read_landing_tolerant(spark, path, SCHEMA)
    assert as_list(tolerant) == [("a", "x", None, None, None, None, None)]


def test_wrong_number_of_columns(spark, tmp_path):
    put(tmp_path, "f.csv", "a,x,1,2024-01-02,2024-01-02T03:04:05,true", "b,x,1")
    path = str(tmp_path / "f.csv")
    with pytest.raises(Exception):
        csv_landing.read_landing(spark, path, SCHEMA).collect()
    kept = csv_landing.read_landing_tolerant(spark, path, SCHEMA)
    assert [r._bad_line for r in kept.filter("_bad_line IS NOT NULL").collect()] == ["b,x,1"]


def test_line_breaks_inside_quotes(spark, tmp_path):
    put(tmp_path, "f.csv", 'a,"one\ntwo, ""x""\n",1,,,', 'b,"\n\n",2,,,', "c,plain,3,,,")
    got = csv_landing.read_landing(spark, str(tmp_path / "f.csv"), SCHEMA)
    assert [r[:3] for r in as_list(got.select("id", "note", "n"))] == [
        ("a", 'one\ntwo, "x"\n', 1), ("b", "\n\n", 2), ("c", "plain", 3)]


def test_broken_records_go_to_quarantine(spark, tmp_path):
    file = LandingFile("raw_sub_x", "sub_x/rows.csv", "SUB_X")
    good = 'a,"x\ny",1,2024-01-02,2024-01-02T03:04:05,true'
    put(tmp_path / "in" / "sub_x", "rows.csv", good, "b,x,1", "c,x,8x,,,", "d,x,1,2024-02-30,,", "e,,,,,,7")
    (tmp_path / "in" / "sub_x" / "rows.csv.bak").write_text("h\nnot a delivery\n")
    BRONZE["raw_sub_x"] = SCHEMA
    try:
        with pytest.raises(Exception):
            csv_landing.load_all(spark, str(tmp_path / "in"), str(tmp_path / "strict"), [file])
        out = str(tmp_path / "out")
        loaded = csv_landing.load_all(spark, str(tmp_path / "in"), out, [file], datetime(2024, 1, 1), quarantine=True)
    finally:
        del BRONZE["raw_sub_x"]
    assert [r.id for r in loaded["raw_sub_x"].collect()] == ["a"]
    kept = read_table(spark, f"{out}/raw_sub_x__quarantine").collect()
    assert {(r._problem, r._record.split(",")[0]) for r in kept} == {
        ("columns", "b"), ("n", "c"), ("d", "d"), ("columns", "e")}
    assert {r._subsidiary_code for r in kept} == {"SUB_X"}
    note = snapshots.current(spark, f"{out}/raw_sub_x").note
    assert note["arrived_at"] == "2024-01-01T00:00:00"


def test_gzipped_single_files_are_taken(spark, raw, tmp_path):
    file = LANDING[1]
    rows = raw[file.table].select(*file.schema.names)
    csv_landing.write_landing(rows.coalesce(1), str(tmp_path / "parts"))
    part = next((tmp_path / "parts").glob("*.csv.gz"))
    (tmp_path / "in" / "sub_a").mkdir(parents=True)
    (tmp_path / "in" / "sub_a" / "customers.csv.gz").write_bytes(part.read_bytes())
    got = csv_landing.load_file(spark, str(tmp_path / "in"), file)
    assert as_set(got.select(*file.schema.names)) == as_set(rows)
    first = csv_landing.fingerprint(spark, str(tmp_path / "in"), file)
    (tmp_path / "in" / "sub_a" / "customers.csv.gz").write_bytes(part.read_bytes() + b"")
    import os
    os.utime(tmp_path / "in" / "sub_a" / "customers.csv.gz", (1, 1))
    assert csv_landing.fingerprint(spark, str(tmp_path / "in"), file) != first


def test_seeds_are_read_by_their_header(spark, tmp_path):
    schema = gl_mapping(spark).schema
    path = tmp_path / "seeds" / "gl_account_mapping.csv"
    path.parent.mkdir()
    path.write_text(",".join(schema.names) + '\nSUB_A,X,GRP-1,"Name, quoted",REVENUE,\n')
    got = load_mapping(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == [("SUB_A", "X", "GRP-1", "Name, quoted", "REVENUE", None)]
    path.write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        load_mapping(spark, str(tmp_path))
    assert load_mapping(spark, str(tmp_path / "none")).count() == gl_mapping(spark).count()


def test_files_are_chosen_by_pattern(spark, tmp_path):
    line = "a,x,1,2024-01-02,2024-01-02T03:04:05,true"
    put(tmp_path, "sales.csv", line)
    put(tmp_path, "other.csv", line, line)
    got = csv_landing.read_landing(spark, str(tmp_path), SCHEMA, pattern="sales*.csv")
    assert got.count() == 1


def test_written_rows_come_back(spark, rows, tmp_path):
    df = rows("id string, note string, n int, d date, t timestamp_ntz, b boolean",
              ("a", 'q "w", e', 1, datetime(2024, 1, 2).date(), datetime(2024, 1, 2, 3, 4, 5), True),
              ("b", None, None, None, None, None))
    csv_landing.write_landing(df, str(tmp_path / "f.csv"))
    assert list((tmp_path / "f.csv").glob("*.csv.gz"))
    got = csv_landing.read_landing(spark, str(tmp_path / "f.csv"), SCHEMA)
    assert as_set(got) == as_set(df)


def test_ddl_is_idempotent(spark):
    for _ in range(2):
        ensure_databases(spark, ["ddl_check"])
        ensure_table(spark, "ddl_check.raw_sub_a_customers", BRONZE["raw_sub_a_customers"])
    assert spark.table("ddl_check.raw_sub_a_customers").schema.names == (
        BRONZE["raw_sub_a_customers"].names)


@pytest.fixture(scope="module")
def raw(spark):
    return testtables.bronze(spark, SMALL)


DAY = {
    "raw_sub_a_sales": "order_date", "raw_sub_b_shipments": "ship_date",
    "raw_sub_c_loans": "origination_date", "raw_sub_d_orders": "order_date",
    "raw_sub_e_leases": "start_date",
}


def land(spark, raw, root, until):
    """Landing files of one year; shipments only up to a day."""
    for file in LANDING:
        df = raw[file.table]
        if file.table in DAY:
            df = df.filter(F.year(DAY[file.table]) == 1998)
        if until and file.table == "raw_sub_b_shipments":
            df = df.filter(F.col("modified_ts") <= F.lit(until))
        csv_landing.write_landing(df.select(*file.schema.names), f"{root}/{file.path}")
    quotes = testtables.fx_quotes(spark, SMALL)
    quotes.select(*[F.col(c).cast("string") for c in quotes.columns]).write.mode(
        "overwrite").option("header", True).csv(f"{root}/fx/quotes.csv")


def test_second_run_equals_a_full_rebuild(spark, raw, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "warehouse")
    settings = Settings(testtables.CALENDAR_START, testtables.CALENDAR_END, testtables.AS_OF, testtables.RATES_END)
    land(spark, raw, landing, datetime(1998, 6, 15))
    first = run_pipeline(spark, landing, root, "r1", settings, datetime(2002, 1, 1))
    some = first.tables["mart_freight_ops"].count()
    counts = {r.target_table: r.new_rows for r in first.new_rows.collect()}
    assert counts["raw_sub_e_leases"] == first.tables["raw_sub_e_leases"].count() > 0

    land(spark, raw, landing, None)
    second = run_pipeline(spark, landing, root, "r2", settings, datetime(2002, 1, 2))
    counts = {r.target_table: r.new_rows for r in second.new_rows.collect()}
    assert counts["raw_sub_a_sales"] == 0 and counts["raw_sub_b_shipments"] > 0

    mart = second.tables["mart_freight_ops"]
    whole = marts_business.freight_ops(
        second.tables["stg_sub_b_shipments"], second.tables["dim_date"], settings.days)
    assert as_set(mart.drop("load_timestamp")) == as_set(whole) and mart.count() > some
    old = mart.filter(F.col("load_timestamp") < F.lit(datetime(2002, 1, 2)))
    assert 0 < old.count() < mart.count()  # untouched months were left alone

    facts = second.tables["ent_transaction"]
    rows_before, whole_before = facts.count(), as_set(whole)
    assert facts.groupBy("transaction_key").count().filter("count > 1").count() == 0
    config = read_table(spark, f"{root}/control/ingestion_config")
    assert config.count() == 6 and config.filter("last_loaded_at IS NULL").count() == 0
    report = second.report
    assert report.filter("rule = 'not_null' AND failing_rows > 0").count() == 0
    assert report.filter("rule = 'relationship' AND failing_rows > 0").count() == 0
    assert spark.table("stg_sub_a_sales").count() == second.tables["raw_sub_a_sales"].count()
    assert spark.table("integration.ent_transaction").count() == rows_before
    assert spark.table("marts.mart_freight_ops").count() == len(whole_before)
    assert {r.status for r in second.freshness.collect()} == {"pass"}

    # Only two sources deliver anew; the run id is used again; the others are three days old
    late = raw["raw_sub_b_shipments"].filter(F.year("ship_date") == 1999)
    file = next(f for f in LANDING if f.table == "raw_sub_b_shipments")
    known = raw[file.table].filter(F.year("ship_date") == 1998)
    moved = known.unionByName(late).withColumn("modified_ts", F.col("modified_ts"))
    csv_landing.write_landing(moved.select(*file.schema.names), f"{landing}/{file.path}")
    third = run_pipeline(spark, landing, root, "r2", settings, datetime(2002, 1, 5))
    statuses = {r.target_table: r.status for r in third.freshness.collect()}
    assert statuses.pop("raw_sub_b_shipments") == "pass" and set(statuses.values()) == {"error"}
    assert third.tables["ent_transaction"].count() > rows_before
    whole = as_set(marts_business.freight_ops(
        third.tables["stg_sub_b_shipments"], third.tables["dim_date"], settings.days))
    assert as_set(third.tables["mart_freight_ops"].drop("load_timestamp")) == whole and len(whole) > len(whole_before)
    ledger = read_table(spark, f"{root}/control/loads")
    assert ledger.count() == 3 * 6
    assert ledger.filter("run_id = 'r2' AND target_table = 'raw_sub_b_shipments'").count() == 2
    old = {r.arrived_at for r in ledger.filter("target_table = 'raw_sub_a_customers'").collect()}
    assert len(old) == 2  # written anew for the second run, not for the third
    assert spark.table("marts.mart_freight_ops").count() == len(whole)


def test_amounts_survive_the_landing(spark, raw, tmp_path):
    file = LANDING[0]
    csv_landing.write_landing(raw[file.table].select(*file.schema.names), f"{tmp_path}/{file.path}")
    loaded = csv_landing.load_file(spark, str(tmp_path), file)
    total = F.sum("net_sales")
    assert loaded.agg(total).first()[0] == raw[file.table].agg(total).first()[0]
    assert isinstance(loaded.first().net_sales, Decimal)
