"""Command line: build every model from a driver parquet folder or a CSV landing folder.

    python -m ledgerline --sf-dir /data/sf1 --out /warehouse/bank
    python -m ledgerline --csv-root /landing --out /warehouse/bank --as-of 2024-06-30
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from ledgerline.plans import runner
from ledgerline.sources import csv_scan
from ledgerline.sources.adapter import RawTables


def main() -> None:
    p = argparse.ArgumentParser(prog="ledgerline")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--sf-dir", help="folder of driver parquet tables (adapter input)")
    src.add_argument("--csv-root", help="folder with one sub-folder of CSV files per raw table")
    p.add_argument("--out", required=True, help="output root for the model tables")
    p.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    p.add_argument("--default-start", type=dt.date.fromisoformat, default=dt.date(2020, 1, 1))
    p.add_argument("--permissive", action="store_true", help="malformed numbers become NULL instead of failing")
    p.add_argument("--auto-scale", action="store_true", help="epoch numbers may be seconds, ms, us or ns, told by magnitude")
    p.add_argument("--fail-on-error", action="store_true", help="a data test of severity error fails the run")
    a = p.parse_args()

    spark = SparkSession.builder.getOrCreate()
    raw = RawTables(spark, a.sf_dir) if a.sf_dir else csv_scan.scan_all(spark, a.csv_root, a.permissive)
    ingest = None
    if a.csv_root:
        from pyspark.sql import functions as F

        from ledgerline.operators.quality import union_all

        ingest = union_all(
            csv_scan.list_input_files(spark, f"{a.csv_root.rstrip('/')}/{t}").select(
                F.lit(t).alias("table_name"), F.col("modificationTime").alias("seen_at")
            )
            for t in raw
        )
    result = runner.run(spark, raw, a.out, as_of=a.as_of, default_start=a.default_start, ingest_log=ingest, auto_scale=a.auto_scale, fail_on_error=a.fail_on_error)
    summary = {f"{r['check']} ({r['severity']})": r["failures"] for r in runner.failing_checks(result).collect()}
    print(json.dumps({"tables": result.tables, "check_failures": summary}, indent=2))


if __name__ == "__main__":
    main()
