"""Full run: raw tables -> gates -> every model -> Parquet tables.

Mirrors the reference's scheduled run: validate the sources (freshness of the
feeds, non-empty lookups), then build every model as a full-rebuild table in
dependency order, with the clustered layout each model declares. Each written
table is what later models read: lineage is cut (a lost executor recomputes from
the last written table, not from the raw files) and nothing is built twice.

Tests run between the layers, on what their layer has just staged, and all
tables are published together at the end: a run that fails on the way leaves
the tables of the last good run as they were.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import quality as Q
from ledgerline.plans import checks as C
from ledgerline.plans.models import AS_OF, DEFAULT_START, BankModels
from ledgerline.sources.sink import with_metadata
from ledgerline.sources.versions import VersionedTables

# Layout per model: (cluster_by, bloom filter columns). From the models' configs.
LAYOUT: dict[str, tuple[list[str], list[str]]] = {
    "base_time_dimension": (["utc_date"], []),
    "base_location_hierarchy": ([], []),
    "int_unified_transactions": (["transaction_id"], ["transaction_type", "account_id"]),
    "int_transactions_enriched": (["account_id", "completed_date"], ["account_id"]),
    "int_account_monthly_spine": (["account_id", "month_date"], []),
    "int_monthly_transaction_summary": (["account_id", "month_date"], []),
    "int_transactions_summary": (["account_id", "month_date"], []),
    "dim_account": (["account_id"], ["account_id"]),
    "dim_calendar": (["utc_date"], []),
    "dim_customer": (["customer_id"], ["customer_id"]),
    "fct_transactions": (["account_id", "completed_date"], ["account_id"]),
    "fct_account_monthly_balances": (["account_id", "month_date"], ["account_id"]),
    "report_monthly_business_kpi": (["report_month"], []),
    "report_customer_segmentation": (["customer_segment"], []),
}
# Unique tie-break columns that let a hot cluster key spread over many write tasks.
SPLIT_BY: dict[str, list[str]] = {
    "base_time_dimension": ["time_id"],
    "int_transactions_enriched": ["transaction_id"],
    "fct_transactions": ["transaction_id"],
}
# Build order: a model comes after those it reads; each is read back from its table by the next.
ORDER = [
    "base_time_dimension", "int_unified_transactions", "int_transactions_enriched", "int_account_monthly_spine",
    *[m for m in LAYOUT if m not in ("base_time_dimension", "int_unified_transactions", "int_transactions_enriched", "int_account_monthly_spine")],
]
# --- fixed values: audit columns per model. Load time of the run's staging; processing time of the model ---
LOADED = {
    "base_time_dimension", "int_account_monthly_spine", "int_monthly_transaction_summary", "dim_account",
    "dim_calendar", "dim_customer", "fct_account_monthly_balances",
}
PROCESSED = {
    "dim_account", "dim_customer", "fct_transactions", "fct_account_monthly_balances",
    "report_monthly_business_kpi", "report_customer_segmentation",
}


#: Data tests by the layer that they guard: the next layer is built after them.
TESTS: dict[str, dict[str, Callable[[BankModels], DataFrame]]] = {
    "staging": {
        "not_null": C.not_null_report,
        "unique": C.unique_report,
        "accepted_values": C.accepted_values_report,
        "accepted_range": C.accepted_range_report,
        "expression": C.expression_report,
        "row_count": C.row_count_report,
    },
    "intermediate": {
        "relationships": C.relationships_report,
        "duplicate_transactions": lambda m: Q.duplicate_transactions(m.int_unified_transactions),
        "orphan_transactions": lambda m: Q.orphan_transactions(m.int_unified_transactions, m.stg_accounts),
        "missing_dates": C.missing_dates_report,
        "calendar_unique_per_date": lambda m: Q.calendar_unique_per_date(m.base_time_dimension),
    },
}


@dataclass
class RunResult:
    root: str = ""
    run: int | None = None
    tables: dict[str, str] = field(default_factory=dict)
    gates: dict[str, DataFrame] = field(default_factory=dict)
    checks: dict[str, DataFrame] = field(default_factory=dict)


def _model_frame(m: BankModels, name: str) -> DataFrame:
    target = getattr(m, name)
    return target() if callable(target) else target


def run(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    out_root: str,
    as_of: dt.date = AS_OF,
    default_start: dt.date = DEFAULT_START,
    ingest_log: DataFrame | None = None,
    fail_on_critical: bool = True,
    fail_on_error: bool | Collection[str] = False,
    auto_scale: bool = False,
    keep_runs: int = 2,
) -> RunResult:
    """Build every model into versioned tables below ``out_root`` and return paths and check frames.

    ``fail_on_critical``: a stale high-frequency table stops the run before it writes. ``fail_on_error``: a data test (any,
    or those named) with failures of severity ``error`` stops the run before the next layer is built; ``warn`` is only
    reported. A run that stops publishes nothing and removes what it staged. The versions of the last ``keep_runs`` runs
    stay (see ``VersionedTables``)."""
    out = VersionedTables(spark, out_root)
    result = RunResult(out.root)
    m = BankModels(raw, as_of=as_of, default_start=default_start, auto_scale=auto_scale)
    cats = Q.table_categories(spark)

    # 1. gates: non-empty lookups always; freshness when an ingest log is given
    lookups = C.non_empty_report(m, spark)
    result.gates["non_empty"] = lookups
    if ingest_log is not None:
        fresh = Q.freshness(ingest_log, cats)
        summary = Q.validation_summary(fresh, lookups)
        result.gates["freshness"] = fresh
        result.gates["validation_summary"] = summary
        if fail_on_critical and summary.where("severity = 'critical'").limit(1).count() > 0:
            raise RuntimeError("critical validation failed: a high-frequency table is stale")

    loaded_at = dt.datetime.now()

    def build(names: Iterable[str]) -> None:
        """Every model once; consumers start from the staged table, without its audit columns."""
        for name in names:
            cluster, bloom = LAYOUT[name]
            model = _model_frame(m, name)
            df = with_metadata(model, loaded_at if name in LOADED else None, name in PROCESSED)
            table = out.stage(df, name, cluster_by=cluster, bloom_columns=bloom, split_by=SPLIT_BY.get(name, []))
            m.replace(name, table.select(*model.columns))

    def test(layer: str) -> None:
        made = {name: check(m) for name, check in TESTS[layer].items()}
        result.checks |= made
        stops = made if fail_on_error is True else {n: d for n, d in made.items() if fail_on_error and n in fail_on_error}
        if stops:
            failed = failing_checks(stops).where("severity = 'error' and failures > 0").select("check", "failures").collect()
            if failed:  # at most one row per check
                raise RuntimeError(f"data tests of severity error failed: {[tuple(r) for r in failed]}")

    # 2. layer by layer; the tests of a layer before the models that read it
    try:
        test("staging")
        build(ORDER[:2])
        test("intermediate")
        build(ORDER[2:])
    except Exception:
        out.discard()
        raise
    result.run = out.publish()
    out.vacuum(keep_runs)
    result.tables = {name: f"{out.root}/{name}" for name in ORDER}
    return result


def failing_checks(checks: RunResult | Mapping[str, DataFrame]) -> DataFrame:
    """One row per check and severity with its failure count (drives an alert, like the DAG's summary)."""
    if isinstance(checks, RunResult):
        checks = checks.checks

    def count_of(name: str, df: DataFrame) -> DataFrame:
        severity = F.col("status") if "status" in df.columns else F.lit("error")
        if "failures" in df.columns:
            n = F.sum("failures")
        elif "failing_rows" in df.columns:
            n = F.sum("failing_rows")
        elif "error_type" in df.columns:
            n = F.count_if(F.col("error_type").isNotNull())
        else:
            n = F.count(F.lit(1))
        if "status" in df.columns:
            return df.where(severity != "pass").groupBy(severity.alias("severity")).agg(n.cast("bigint").alias("failures")).select(
                F.lit(name).alias("check"), "severity", "failures"
            )
        return df.agg(F.coalesce(n, F.lit(0)).cast("bigint").alias("failures")).select(
            F.lit(name).alias("check"), severity.alias("severity"), "failures"
        )

    return Q.union_all(count_of(n, df) for n, df in checks.items())
