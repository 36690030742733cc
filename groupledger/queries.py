"""The registered queries over the test tables, by name."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .functions.dates import month_start
from .functions.numbers import money_sum
from .operators import control, incremental
from .operators.calendar import calendar_covering
from .operators.joins import insert_if_absent
from .operators.quality import (
    Accepted, Between, HasType, NotNull, Related, Unique, check_all, reports,
)
from .plans import entities, marts_business, marts_group, quality_rules as rules, refresh, staging
from .plans.warehouse import MARTS, Settings, Warehouse
from .schemas import BRONZE
from .session import shared_folder, side_by_side
from .sources import csv_landing, snapshots, testtables
from .sources.reference_rows import CODES, INGESTION, ingestion_config
from .sources.registry import LANDING, LandingFile
from .sources.tables import (
    create_keyed_table, merge_table, read_keyed_table, write_table,
)
from .streaming.available_now import upsert_available

Query = Callable[[SparkSession, str], DataFrame]

_open: dict[tuple[str, str], Warehouse] = {}


def _folder(spark: SparkSession, *parts: str) -> str:
    return "/".join([shared_folder(spark), spark.sparkContext.applicationId, *parts])


def _scratch(spark: SparkSession, name: str) -> str:
    return _folder(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The datasets over one folder of test tables; joined order lines and the entities that
    are aggregates are written once per Spark application, in the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _open:
        label = hashlib.md5(sf_dir.encode()).hexdigest()[:12]
        store = _folder(spark, f"warehouse-{label}")
        _open[key] = Warehouse(
            spark,
            testtables.bronze(spark, sf_dir, store),
            testtables.fx_quotes(spark, sf_dir),
            Settings(
                testtables.CALENDAR_START, testtables.CALENDAR_END, testtables.AS_OF,
                testtables.RATES_END,
            ),
            store=store,
        )
    return _open[key]


# Calendar, reference data, staging, entities, marts


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lineitem = testtables.tables(spark, sf_dir, "orders", "lineitem")
    dates = orders.select(F.col("o_orderdate").cast("date").alias("day")).unionByName(
        lineitem.select(F.col("l_shipdate").cast("date").alias("day"))
    )
    return calendar_covering(dates, "day")


def _staged(code: str) -> Query:
    return lambda spark, sf_dir: warehouse(spark, sf_dir).staged(code)


def _entity(name: str) -> Query:
    return lambda spark, sf_dir: getattr(warehouse(spark, sf_dir), name)


def _mart(name: str) -> Query:
    return lambda spark, sf_dir: getattr(warehouse(spark, sf_dir), name)()


def customer_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = warehouse(spark, sf_dir).mart_customer_360()
    return mart.withColumn("subsidiaries", F.array_join("subsidiaries", ","))


def ent_subsidiary_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    used = w.transactions.groupBy("subsidiary_code").agg(
        F.count("*").alias("transaction_count"),
        F.min("transaction_date").alias("first_transaction"),
        F.max("transaction_date").alias("last_transaction"),
    )
    return w.subsidiaries.join(used, "subsidiary_code", "left")


def gl_mapping_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    used = w.transactions.groupBy(
        "subsidiary_code", F.col("gl_account_code").alias("subsidiary_gl_code")
    ).agg(F.count("*").alias("posting_count"))
    return w.gl_mapping.join(used, ["subsidiary_code", "subsidiary_gl_code"], "left").fillna(
        0, ["posting_count"]
    )


# Incremental loading

CUT = datetime(1998, 6, 30)

# How far each subsidiary's part of the target was loaded; SUB_D never was.
LOADED_UNTIL = {
    "SUB_A": datetime(1998, 6, 30),
    "SUB_B": datetime(1997, 12, 31),
    "SUB_C": datetime(1999, 3, 31),
    "SUB_E": datetime(2000, 12, 31),
}

CONFIG_MARKS = {
    "raw_sub_a_sales": datetime(1998, 6, 30),
    "raw_sub_c_loans": datetime(2000, 1, 1),
    "raw_sub_d_orders": datetime(1999, 1, 1),
}


def _at(moment: datetime) -> Column:
    return F.lit(moment).cast("timestamp_ntz")


def incremental_filter_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    facts = w.transactions
    loaded = F.lit(False)
    for code, until in LOADED_UNTIL.items():
        loaded = loaded | (
            (F.col("subsidiary_code") == code) & (F.col("_loaded_at") <= _at(until))
        )
    target = facts.filter(loaded)
    fresh = incremental.newer_than_target_by_source(
        facts, target, "_loaded_at", "subsidiary_code", CODES
    )
    return fresh.select("transaction_key", "subsidiary_code", "amount_php", "_loaded_at")


def incremental_filter_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = testtables.tables(spark, sf_dir, "lineitem")[0].select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )
    target = lineitem.filter(F.col("l_shipdate") <= _at(CUT))
    return incremental.newer_than_target(lineitem, target, "l_shipdate")


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every sale the columns in use, joined and written once; the stored order lines have
    twice the bytes."""
    sales = testtables.sales_amounts(spark, sf_dir).select(
        F.col("order_id").alias("transaction_nk"), F.col("customer_id").alias("customer_id_nk"),
        F.col("order_date").cast("date").alias("transaction_date"),
        F.col("net_sales").alias("amount_local"),
        F.col("updated_at").cast("timestamp_ntz").alias("_loaded_at"),
    )
    return write_table(sales, _scratch(spark, "staged"))


def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales loaded until the cut, then a batch of the later ones together with
    restated amounts for the quarter before the cut."""
    sales = _sales(spark, sf_dir)
    target = sales.filter(F.col("_loaded_at") <= _at(CUT))
    quarter = F.col("_loaded_at").between(_at(datetime(1998, 4, 1)), _at(CUT))
    restated = sales.filter(quarter).withColumns({
        "amount_local": (F.col("amount_local") + 100).cast("decimal(15,2)"),
        "_loaded_at": _at(datetime(1998, 7, 1)),
    })
    batch = sales.filter(F.col("_loaded_at") > _at(CUT)).unionByName(restated)
    path, keys, order = _scratch(spark, "sales"), ["transaction_nk"], ["_loaded_at"]
    create_keyed_table(target, path, keys, order)
    merge_table(spark, path, batch, keys, order, run_id="first")
    return read_keyed_table(spark, path, sales.schema)


def incremental_upsert_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order and line number repeat in the lines, so the later load brings new versions
    of keys that are already in the stored table."""
    lines = testtables.tables(spark, sf_dir, "lineitem")[0].select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    keys, order = ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    shipped = F.col("l_shipdate")
    path = _scratch(spark, "lines")
    create_keyed_table(lines.filter(shipped <= _at(CUT)), path, keys, order)
    merge_table(spark, path, lines.filter(shipped > _at(CUT)), keys, order, run_id="later")
    return read_keyed_table(spark, path, lines.schema)


def config_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert-if-absent: products known from early loads keep their row, products
    first seen later are added."""
    staged = warehouse(spark, sf_dir).all_staged
    early = {
        code: df.filter(F.col("_loaded_at") <= _at(datetime(1995, 3, 31)))
        for code, df in staged.items()
    }
    return insert_if_absent(
        entities.products(early), entities.products(staged), ["subsidiary_code", "product_key"]
    )


def _price_band() -> Column:
    return F.when(F.col("o_totalprice") >= 250000, "HIGH").otherwise("LOW")


def _order_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders before 1998 with a priority; later ones with a price band instead."""
    orders = testtables.tables(spark, sf_dir, "orders")[0]
    late = F.col("o_orderdate") >= _at(datetime(1998, 1, 1))
    shared = ["o_orderkey", "o_custkey", "o_orderdate"]
    return (
        orders.filter(~late).select(*shared, "o_orderpriority"),
        orders.filter(late).select(*shared, _price_band().alias("price_band")),
    )


def schema_sync_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _order_versions(spark, sf_dir)
    return incremental.sync_all_columns(target, batch).unionByName(batch)


def schema_append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = incremental.append_new_columns(*_order_versions(spark, sf_dir))
    return target.unionByName(batch)


FIRST_RUN, SECOND_RUN = datetime(2002, 1, 1), datetime(2002, 1, 2)
MID_MONTH = datetime(1998, 6, 15)


def _months_after(rows: DataFrame) -> DataFrame:
    fresh = incremental.newer_than(rows, "_loaded_at", MID_MONTH)
    return fresh.select(month_start(F.col("transaction_date")).alias("month"))


def touched_period_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freight mart stored in mid-month, then refreshed with everything later."""
    w = warehouse(spark, sf_dir)
    path, shipments = _scratch(spark, "freight"), w.staged("SUB_B")

    def build(rows: DataFrame, calendar: DataFrame) -> DataFrame:
        return marts_business.freight_ops(rows, calendar, w.days)

    known = shipments.filter(F.col("_loaded_at") <= _at(MID_MONTH))
    refresh.refresh_periods(spark, path, known, w.calendar, build, FIRST_RUN, None)
    later = _months_after(shipments)
    mart = refresh.refresh_periods(spark, path, shipments, w.calendar, build, SECOND_RUN, later)
    return mart.drop("load_timestamp")


def touched_period_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost-centre totals over a stored fact: built from the rows up to mid-month, then, after
    the later ones are merged into the fact, refreshed for the months that they changed.

    The fact keeps all rows with the columns that its key, its order and the totals need."""
    w = warehouse(spark, sf_dir)
    needed = dict.fromkeys([*refresh.FACT_KEY, *marts_group.SPEND_COLUMNS, "_loaded_at"])
    path, facts = _scratch(spark, "spend"), refresh.with_month(w.transactions.select(*needed))
    mart, order = f"{path}/totals", ["_loaded_at"]

    def build(rows: DataFrame, calendar: DataFrame) -> DataFrame:
        return marts_group.cost_center_totals(rows, w.products, calendar, w.days)

    def totals(now: datetime) -> DataFrame:
        months = refresh.changed_months(spark, f"{path}/fact", mart)
        stored = refresh.facts_by_month(spark, f"{path}/fact")
        built = refresh.built_from(spark, f"{path}/fact")
        return refresh.refresh_periods(spark, mart, stored, w.calendar, build, now, months, built)

    known = facts.filter(F.col("_loaded_at") <= _at(MID_MONTH))
    create_keyed_table(known, f"{path}/fact", refresh.FACT_KEY, order, refresh.FACT_LAYOUT)
    totals(FIRST_RUN)
    later = incremental.newer_than(facts, "_loaded_at", MID_MONTH)
    merge_table(spark, f"{path}/fact", later, refresh.FACT_KEY, order, "later")
    return marts_group.with_spend_shares(totals(SECOND_RUN).drop("load_timestamp"))


def stream_available_now_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events streamed into a table of the latest event per user and type."""
    events = testtables.tables(spark, sf_dir, "events")[0]
    path = _scratch(spark, "events")
    upsert_available(
        spark, sf_dir, events.schema, f"{path}/table", f"{path}/checkpoint",
        keys=["user_id", "event_type"], order=["ts", "event_id"], pattern="events.parquet",
    )
    return read_keyed_table(spark, f"{path}/table", events.schema)


def stream_two_loads_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table from three arrivals: the middle of the time range, its end, and
    last its start, whose versions are older than those in the table."""
    events = testtables.tables(spark, sf_dir, "events")[0]
    path = _scratch(spark, "arrivals")
    second = F.col("ts").cast("timestamp").cast("long")
    first, last = events.agg(F.min(second), F.max(second)).first()
    third = ((last or 0) - (first or 0)) // 3
    part = F.when(second < (first or 0) + third, 2).when(second > (last or 0) - third, 1)
    for arrival in range(3):
        events.filter(F.coalesce(part, F.lit(0)) == arrival).write.mode("append").parquet(
            f"{path}/source"
        )
        upsert_available(
            spark, f"{path}/source", events.schema, f"{path}/table", f"{path}/checkpoint",
            keys=["user_id", "event_type"], order=["ts", "event_id"],
        )
    return read_keyed_table(spark, f"{path}/table", events.schema)


# Ingestion control


def _bronze_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = warehouse(spark, sf_dir).raw
    return control.load_times({row[4]: (raw[row[4]], row[6]) for row in INGESTION})


def _config(spark: SparkSession) -> DataFrame:
    known = ingestion_config(spark, CONFIG_MARKS)
    return known.withColumn("active", F.col("target_table") != "raw_sub_e_leases")


def ingest_new_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = _bronze_times(spark, sf_dir)
    return control.new_row_counts(_config(spark), times)


def ingest_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    times = _bronze_times(spark, sf_dir)
    return control.advance_marks(_config(spark), times, SECOND_RUN)


def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the raw tables by their change time; those without one never loaded."""
    return control.freshness(_bronze_times(spark, sf_dir), datetime(2001, 11, 5, 2))


# CSV landing


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = warehouse(spark, sf_dir).raw["raw_sub_a_sales"]
    landing, file = _scratch(spark, "landing"), LANDING[0]
    csv_landing.write_landing(raw.select(*file.schema.names), f"{landing}/{file.path}")
    loaded = csv_landing.load_file(spark, landing, file, testtables.LOADED_AT)
    return loaded.drop("_loaded_at")


# Amount column and day column to sum up per raw table.
LOAD_SUMMARY = {
    "raw_sub_a_sales": ("net_sales", "order_date"),
    "raw_sub_a_customers": ("cast(is_active AS int)", "join_date"),
    "raw_sub_b_shipments": ("total_revenue", "ship_date"),
    "raw_sub_c_loans": ("monthly_payment", "origination_date"),
    "raw_sub_d_orders": ("order_value_php", "order_date"),
    "raw_sub_e_leases": ("annual_rent_php", "start_date"),
}


def bronze_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six landing files through the registry into raw tables, then summed up. A landing
    file goes when its table is stored, so that they never take disk all at once."""
    raw = warehouse(spark, sf_dir).raw
    root = _scratch(spark, "bronze")
    rows = {file: raw[file.table].select(*BRONZE[file.table].names) for file in LANDING}

    def deliver(file: LandingFile) -> dict[str, DataFrame]:
        landing = f"{root}/landing"
        csv_landing.write_landing(rows[file], f"{landing}/{file.path}")
        table = csv_landing.load_all(spark, landing, f"{root}/bronze", [file])
        snapshots.remove(spark, f"{landing}/{file.path}")
        return table

    tables = {
        name: df for table in side_by_side(spark, deliver, LANDING, at_once=2)
        for name, df in table.items()
    }
    lines = [
        df.groupBy("_subsidiary_code").agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("row_count"),
            money_sum(F.expr(amount)).alias("total"),
            F.min(day).alias("first_day"),
            F.max(day).alias("last_day"),
        )
        for name, df in tables.items()
        for amount, day in [LOAD_SUMMARY[name]]
    ]
    out = lines[0]
    for line in lines[1:]:
        out = out.unionByName(line)
    return out


# Data quality


def quality_tables(w: Warehouse) -> dict[str, DataFrame]:
    """Every raw, staged and conformed table under its name."""
    return {
        **w.raw,
        **{staging.VIEW_NAMES[code]: df for code, df in w.all_staged.items()},
        "fx_rates": w.fx_rates,
        "gl_account_mapping": w.gl_mapping,
        "ent_subsidiary": w.subsidiaries,
        "ent_customer": w.customers,
        "ent_account": w.accounts,
        "ent_product": w.products,
        "ent_transaction": w.transactions,
    }


# The two literal seed tables have no data behind them and are left to the tests.
TABLE_RULES = {
    name: listed
    for name, listed in {
        **rules.BRONZE_RULES, **rules.STAGING_RULES, **rules.INTEGRATION_RULES
    }.items()
    if name not in ("gl_account_mapping", "ent_subsidiary")
}


def _quality(kind: type) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = quality_tables(warehouse(spark, sf_dir))
        return check_all(tables, rules.of_kind(TABLE_RULES, kind), tables)

    return run


def dq_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    return check_all(w.raw, rules.reconciliation_rules(w.settings.as_of))


def dq_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts of the report are worked out and stored one after another, so that what one
    shuffles is gone before the next begins."""
    w, path = warehouse(spark, sf_dir), _scratch(spark, "mart_checks")
    parts = [
        write_table(part, f"{path}/{name}_{number}")
        for name, listed in rules.MART_RULES.items()
        for number, part in enumerate(reports(name, getattr(w, name)(), listed))
    ]
    return reduce(DataFrame.unionByName, parts)


def dq_subsidiaries_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    pnl = w.mart_consolidated_pnl()
    missing = rules.missing_subsidiaries(w.subsidiaries, pnl).select(
        "subsidiary_code", F.lit(True).alias("missing")
    )
    lines = pnl.groupBy("subsidiary_code").agg(F.count("*").alias("pnl_lines"))
    return (
        w.subsidiaries.select("subsidiary_code", "subsidiary_name")
        .join(lines, "subsidiary_code", "left")
        .join(missing, "subsidiary_code", "left")
        .fillna({"missing": False})
    )


def dq_interco_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    return rules.unbalanced_pair_counts(w.transactions, w.gl_mapping)


QUERIES: dict[str, Query] = {
    "dim_date": dim_date,
    "fx_rates_prepared": _entity("fx_rates"),
    "gl_mapping_usage": gl_mapping_usage,
    "stg_retail": _staged("SUB_A"),
    "stg_freight": _staged("SUB_B"),
    "stg_loans": _staged("SUB_C"),
    "stg_orders": _staged("SUB_D"),
    "stg_leases": _staged("SUB_E"),
    "ent_subsidiary_usage": ent_subsidiary_usage,
    "ent_customer": _entity("customers"),
    "ent_account": _entity("accounts"),
    "ent_product": _entity("products"),
    "ent_transaction": _entity("transactions"),
    **{name: _mart(name) for name in MARTS},
    "mart_customer_360": customer_360,
    "ingest_new_row_counts": ingest_new_row_counts,
    "ingest_watermarks": ingest_watermarks,
    "config_merge": config_merge,
    "incremental_filter_by_source": incremental_filter_by_source,
    "incremental_filter_global": incremental_filter_global,
    "incremental_upsert": incremental_upsert,
    "incremental_upsert_composite": incremental_upsert_composite,
    "schema_sync_all": schema_sync_all,
    "schema_append_new": schema_append_new,
    "touched_period_refresh": touched_period_refresh,
    "touched_period_spend": touched_period_spend,
    "stream_available_now_upsert": stream_available_now_upsert,
    "stream_two_loads_upsert": stream_two_loads_upsert,
    "source_freshness": source_freshness,
    "csv_round_trip": csv_round_trip,
    "bronze_load": bronze_load,
    "dq_not_null": _quality(NotNull),
    "dq_unique": _quality(Unique),
    "dq_accepted_values": _quality(Accepted),
    "dq_between": _quality(Between),
    "dq_type": _quality(HasType),
    "dq_relationships": _quality(Related),
    "dq_reconciliation": dq_reconciliation,
    "dq_marts": dq_marts,
    "dq_subsidiaries_present": dq_subsidiaries_present,
    "dq_interco_balance": dq_interco_balance,
}
