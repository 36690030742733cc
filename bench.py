"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of test tables, BENCH_CPUS the number of cores,
BENCH_QUERIES (optional, comma-separated) a choice of queries.

Entities are written to the shared folder on first use, as the pipeline does;
that first use is timed on its own under ``build_...``, so the marts' times are
those of reading the stored entities. Every result is computed in full and
thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from groupledger.plans.warehouse import MARTS  # noqa: E402
from groupledger.queries import QUERIES, warehouse  # noqa: E402
from groupledger.session import local_session  # noqa: E402

BUILDS = ("fx_rates", "customers", "accounts", "products", "transactions")
HEADLINE = (
    "dim_date",
    "stg_retail",
    "stg_freight",
    "stg_loans",
    "stg_orders",
    "stg_leases",
    *MARTS,
    "ingest_new_row_counts",
    "ingest_watermarks",
    "incremental_filter_by_source",
    "incremental_upsert",
    "incremental_upsert_composite",
    "touched_period_refresh",
    "stream_available_now_upsert",
    "dq_relationships",
    "dq_interco_balance",
)


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")

    def drain(name: str) -> None:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    timed(lambda: drain("incremental_filter_global"))  # starts the session's threads
    times = {}
    for name in BUILDS:
        times[f"build_{name}"] = timed(lambda: getattr(warehouse(spark, folder), name))
    for name in chosen:
        times[name] = timed(lambda: drain(name))
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
