"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed fully with the no-op sink (every row computed, nothing
collected) after one warm-up query. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "stg_pix_movements",
    "int_unified_transactions",
    "int_transactions_enriched",
    "int_account_monthly_spine",
    "int_monthly_transaction_summary",
    "int_transactions_summary",
    "dim_account",
    "dim_customer",
    "fct_transactions",
    "fct_account_monthly_balances",
    "report_monthly_business_kpi",
    "report_customer_segmentation",
    "dq_unique",
    "dq_relationships",
    "dq_orphan_transactions",
    "dq_duplicate_transactions",
    "scan_pix_movements",
    "stream_ingest_pix",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from ledgerline.plans.catalog import QUERIES
    from ledgerline.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    # warm-up: JVM, code paths, file listing caches
    QUERIES["stg_accounts"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for key in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t0, 3)
        print(f"{key}: {times[key]}s", file=sys.stderr, flush=True)
    # Full run: every model written once as a table, shared models re-read (not in the total).
    from ledgerline.plans import runner
    from ledgerline.session import scratch_path
    from ledgerline.sources.adapter import RawTables

    t0 = time.perf_counter()
    runner.run(spark, RawTables(spark, sf_dir), scratch_path(spark, "bench", "warehouse"))
    full_run = round(time.perf_counter() - t0, 3)
    print(f"full_run: {full_run}s", file=sys.stderr, flush=True)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "full_run_sec": full_run,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "spark": spark.version,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
