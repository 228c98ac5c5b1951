"""Every registered query: ``(spark, sf_dir) -> DataFrame`` over the driver tables.

Model queries are lazy. Source/sink queries (CSV scan, preview, listing,
streaming ingest) read the adapter's tables from CSV files, which are staged once
per session below the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import quality as Q
from ledgerline.plans import checks as C
from ledgerline.plans import intermediate as I
from ledgerline.plans import marts as M
from ledgerline.plans.bucketed import BucketedModels
from ledgerline.plans.models import BankModels
from ledgerline.session import scratch_path
from ledgerline.sources import csv_scan
from ledgerline.sources.adapter import RawTables
from ledgerline.functions.timeparse import null_marker, parse_ts
from ledgerline.sources.schemas import RAW_TABLES, TABLE_KEYS
from ledgerline.sources.sink import materialize
from ledgerline.streaming import pipes
from ledgerline.streaming.feeds import FEEDS, unify_available
from ledgerline.streaming.ingest import ingest_available

#: Least buckets of the registered queries' tables; larger tables have more.
BUCKETS = 16

Query = Callable[[SparkSession, str], DataFrame]

def models(spark: SparkSession, sf_dir: str) -> BankModels:
    return BankModels(RawTables(spark, sf_dir))


def _model_query(attr: str, *args) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        target = getattr(models(spark, sf_dir), attr)
        return target(*args) if callable(target) else target

    run.__name__ = attr
    return run


_EXPORTED: dict[tuple[str, str, str], str] = {}


def _export_csv(spark: SparkSession, sf_dir: str, tables: list[str]) -> str:
    """The raw tables as CSV files, staged once per session, folder and table below the session's scratch folder."""
    raw, session = RawTables(spark, sf_dir), spark.sparkContext.applicationId
    if (session, sf_dir, "") not in _EXPORTED:
        _EXPORTED[session, sf_dir, ""] = scratch_path(spark, "csv")
    root = _EXPORTED[session, sf_dir, ""]
    for t in tables:
        if (session, sf_dir, t) not in _EXPORTED:
            _EXPORTED[session, sf_dir, t] = csv_scan.write_csv(raw[t], t, root)
    return root


def _scan_query(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return csv_scan.scan_table(spark, _export_csv(spark, sf_dir, [table]), table)

    run.__name__ = f"scan_{table}"
    return run


def parse_null_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    ins = RawTables(spark, sf_dir)["transfer_ins"]
    raw_value = F.col("transaction_completed_at")
    cleaned = null_marker(raw_value)
    return ins.select(
        F.col("id").alias("transaction_id"),
        raw_value.alias("raw_value"),
        parse_ts(cleaned).alias("parsed_at"),
        cleaned.isNull().alias("is_missing"),
    )


def raw_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _export_csv(spark, sf_dir, ["pix_movements"])
    return csv_scan.raw_preview(spark, root, "pix_movements", n=5, order_by="id")


def list_input_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged tables with the number of data lines in their listed files."""
    return csv_scan.rows_per_table(spark, _export_csv(spark, sf_dir, list(RAW_TABLES)), list(RAW_TABLES))


def _pipe_query(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        inbox = f"{_export_csv(spark, sf_dir, [table])}/{table}"
        sink, ckpt = scratch_path(spark, "stream", "sink"), scratch_path(spark, "stream", "checkpoint")
        out = ingest_available(spark, table, inbox, sink, ckpt)
        return out.select(*[n for n, _ in RAW_TABLES[table]])

    run.__name__ = f"stream_ingest_{table}"
    return run


def stream_unified_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three feeds streamed through staging and the union into one sink."""
    root = _export_csv(spark, sf_dir, FEEDS)
    sink = scratch_path(spark, "stream", "unified")
    ckpt = scratch_path(spark, "stream", "unified-checkpoint")
    return unify_available(spark, root, sink, ckpt)


def stream_ingest_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 13 tables loaded by one stream: rows and sum of the keys per loaded table."""
    landing, raw_root = _export_csv(spark, sf_dir, list(RAW_TABLES)), scratch_path(spark, "stream", "all")
    pipes.load_available(spark, landing, raw_root, scratch_path(spark, "stream", "all-checkpoint"))
    sums = [
        pipes.loaded_table(spark, raw_root, t).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col(k).cast("decimal(28,0)")).cast("decimal(38,0)").alias("key_sum")).select(F.lit(t).alias("table_name"), "n_rows", "key_sum")
        for t, k in TABLE_KEYS.items()
    ]
    return Q.union_all(sums)


def materialize_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir)
    path = scratch_path(spark, "tables", "fct_account_monthly_balances")
    if not m.calendar_fits:  # the months are joined by a shuffle, so only the finished rows can be clustered
        return materialize(m.fct_account_monthly_balances, path, cluster_by=["account_id", "month_date"], bloom_columns=["account_id"])
    # one row per account is clustered, not one per account and month: its months follow in order. The number of files is
    # given, as partitions merged by their size would be too few for the rows that the accounts expand to.
    accounts = I.accounts_with_months(m.stg_accounts, I.monthly_measures(m.int_transactions_enriched))
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return materialize(
        accounts, path, cluster_by=["account_id"], expand=m.balances_of_accounts, bloom_columns=["account_id"], files_per_write=files
    )


def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.date_spine_of_data(models(spark, sf_dir))


def dq_validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir)
    return Q.validation_summary(C.freshness_report(m), C.non_empty_report(m, spark))


def _with_models(fn: Callable[[BankModels], DataFrame], name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(models(spark, sf_dir))

    run.__name__ = name
    return run


def _bucketed_query(attr: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = BucketedModels.write(models(spark, sf_dir), scratch_path(spark, "bucketed"), buckets=BUCKETS)
        return getattr(tables, attr)()

    run.__name__ = f"bucketed_{attr}"
    return run


QUERIES: dict[str, Query] = {}

# sources and sinks
for _t in RAW_TABLES:
    QUERIES[f"scan_{_t}"] = _scan_query(_t)
QUERIES["parse_null_marker"] = parse_null_marker
QUERIES["list_input_files"] = list_input_files
QUERIES["raw_preview"] = raw_preview
QUERIES["stream_ingest_pix"] = _pipe_query("pix_movements")
QUERIES["stream_ingest_transfer_ins"] = _pipe_query("transfer_ins")
QUERIES["stream_ingest_transfer_outs"] = _pipe_query("transfer_outs")
QUERIES["stream_unified_transactions"] = stream_unified_transactions
QUERIES["stream_ingest_all"] = stream_ingest_all
QUERIES["materialize_roundtrip"] = materialize_roundtrip

# staging and base
for _name in ["stg_accounts", "stg_customers", "stg_pix_movements", "stg_transfer_ins", "stg_transfer_outs",
              "base_location_hierarchy", "base_time_dimension"]:
    QUERIES[_name] = _model_query(_name)

# intermediate
for _name in ["int_unified_transactions", "int_transactions_enriched", "int_account_monthly_spine",
              "int_monthly_transaction_summary"]:
    QUERIES[_name] = _model_query(_name)
QUERIES["int_transactions_summary"] = _model_query("int_transactions_summary", False)
QUERIES["int_transactions_summary_literal"] = _model_query("int_transactions_summary", True)

# marts
for _name in ["dim_account", "dim_calendar", "dim_customer", "fct_account_monthly_balances",
              "report_monthly_business_kpi", "report_customer_segmentation"]:
    QUERIES[_name] = _model_query(_name)
QUERIES["fct_transactions"] = _model_query("fct_transactions", False)
QUERIES["fct_transactions_literal"] = _model_query("fct_transactions", True)
QUERIES["kpi_month_over_month"] = _with_models(lambda m: M.kpi_month_over_month(m.report_monthly_business_kpi), "kpi_month_over_month")
QUERIES["kpi_distinct_accounts"] = _with_models(lambda m: M.monthly_distinct_accounts(m.fct_account_monthly_balances), "kpi_distinct_accounts")
QUERIES["date_spine"] = date_spine

# the same models over tables bucketed by account
for _name in ["dim_account", "int_monthly_transaction_summary", "orphan_transactions"]:
    QUERIES[f"bucketed_{_name}"] = _bucketed_query(_name)

# data quality
QUERIES["dq_not_null"] = _with_models(C.not_null_report, "dq_not_null")
QUERIES["dq_unique"] = _with_models(C.unique_report, "dq_unique")
QUERIES["dq_accepted_values"] = _with_models(C.accepted_values_report, "dq_accepted_values")
QUERIES["dq_relationships"] = _with_models(C.relationships_report, "dq_relationships")
QUERIES["dq_accepted_range"] = _with_models(C.accepted_range_report, "dq_accepted_range")
QUERIES["dq_expression"] = _with_models(C.expression_report, "dq_expression")
QUERIES["dq_row_count"] = _with_models(C.row_count_report, "dq_row_count")
QUERIES["dq_duplicate_transactions"] = _with_models(lambda m: Q.duplicate_transactions(m.int_unified_transactions), "dq_duplicate_transactions")
QUERIES["dq_orphan_transactions"] = _with_models(
    lambda m: Q.orphan_transactions(m.int_unified_transactions, m.stg_accounts),
    "dq_orphan_transactions",
)
QUERIES["dq_missing_dates"] = _with_models(C.missing_dates_report, "dq_missing_dates")
QUERIES["dq_calendar_unique_per_date"] = _with_models(lambda m: Q.calendar_unique_per_date(m.base_time_dimension), "dq_calendar_unique_per_date")
QUERIES["dq_freshness"] = _with_models(C.freshness_report, "dq_freshness")
QUERIES["dq_non_empty"] = lambda spark, sf_dir: C.non_empty_report(models(spark, sf_dir), spark)
QUERIES["dq_validation_summary"] = dq_validation_summary
