"""Data-quality operators.

Each returns a DataFrame: either the failing rows / values, or small summary
rows (one per binding). Everything is a distributed aggregate or anti join;
nothing is collected. Keys are pre-aggregated before any join so a hot key is
reduced map-side before the shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import labels as L
from ledgerline.functions.timeparse import day_sequence


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _tag(df: DataFrame, model: str, column: str) -> DataFrame:
    return df.select(F.lit(model).alias("model"), F.lit(column).alias("column_name"), *df.columns)


# -- generic column tests ----------------------------------------------------------

def not_null_summary(df: DataFrame, model: str, column: str) -> DataFrame:
    return _tag(df.agg(F.count_if(F.col(column).isNull()).alias("failures")), model, column)


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Values of ``column`` seen more than once (NULL is not a value)."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def unique_summary(df: DataFrame, model: str, column: str) -> DataFrame:
    dups = duplicate_values(df, column)
    return _tag(dups.agg(F.count(F.lit(1)).alias("failures")), model, column)


def accepted_values_failures(df: DataFrame, model: str, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside ``values`` with their row counts (NULL is not tested)."""
    bad = (
        df.where(~F.col(column).isin(list(values)))
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    return _tag(bad, model, column)


def relationship_summary(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, model: str, to_model: str
) -> DataFrame:
    """Child keys with no parent: rows and distinct keys.

    The child is first reduced to (key, count) with partial aggregation, so when
    the parent is large the anti join shuffles one row per key however skewed the
    child is. (When the parent is small enough to broadcast, Catalyst moves the
    anti join below the aggregation as a broadcast filter, which is cheaper still.)
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    orphans = keys.join(parent.select(F.col(parent_column).alias("k")), "k", "left_anti")
    summary = orphans.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("failing_rows"),
        F.count(F.lit(1)).alias("failing_keys"),
    )
    return _tag(summary, model, column).select("model", "column_name", F.lit(to_model).alias("to_model"), "failing_rows", "failing_keys")


def feed_relationship_summary(child: DataFrame, feed: str, column: str, parent: DataFrame, to_model: str, models: Sequence[str]) -> DataFrame:
    """``relationship_summary`` of several feeds held in one table, with one pass over child and parent.

    The child is reduced to (feed, key, count) before the anti join; ``models`` lists the feeds, also those without an
    orphan.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(feed).alias("model"), F.col(column).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    orphans = keys.join(parent.select(F.col(column).alias("k")), "k", "left_anti")
    sums = orphans.groupBy("model").agg(F.sum("n").alias("failing_rows"), F.count(F.lit(1)).alias("failing_keys"))
    listed = child.sparkSession.createDataFrame([(m,) for m in models], "model string")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return listed.join(sums, "model", "left").select(
        "model", F.lit(column).alias("column_name"), F.lit(to_model).alias("to_model"), zero("failing_rows"), zero("failing_keys")
    )


def severity(failures: Column, warn_over: int, error_over: int) -> Column:
    return F.when(failures > error_over, "error").when(failures > warn_over, "warn").otherwise("pass")


def out_of_range(c: Column, min_value: float = L.RANGE_MIN, max_value: float = L.RANGE_MAX) -> Column:
    low, high = F.lit(str(min_value)).cast("decimal(18,2)"), F.lit(str(max_value)).cast("decimal(18,2)")
    return (c < low) | (c > high)


def accepted_range_summary(
    df: DataFrame,
    model: str,
    column: str,
    min_value: float = L.RANGE_MIN,
    max_value: float = L.RANGE_MAX,
    warn_over: int = L.RANGE_WARN_OVER,
    error_over: int = L.RANGE_ERROR_OVER,
) -> DataFrame:
    agg = df.agg(F.count_if(out_of_range(F.col(column), min_value, max_value)).alias("failures"))
    return _tag(agg, model, column).select(
        "model", "column_name", "failures", severity(F.col("failures"), warn_over, error_over).alias("status")
    )


def expression_summary(df: DataFrame, model: str, column: str, label: str, condition: Column) -> DataFrame:
    """Rows where ``condition`` is false (NULL is not a failure)."""
    agg = df.agg(F.count_if(~condition).alias("failures"))
    return _tag(agg, model, column).select("model", "column_name", F.lit(label).alias("expression"), "failures")


def row_count_verdict(n: Column, model: Column, above: Column, below: int | None = None) -> list[Column]:
    """The count, the limits and TOO_FEW_ROWS / TOO_MANY_ROWS / NULL."""
    err = F.when(n < above, "TOO_FEW_ROWS")
    if below is not None:
        err = err.when(n > below, "TOO_MANY_ROWS")
    limits = [above.cast("bigint").alias("min_expected"), F.lit(below).cast("bigint").alias("max_expected")]
    return [n.alias("actual_count"), *limits, model.alias("model_name"), err.alias("error_type")]


def row_count_check(df: DataFrame, model: str, above: int = 0, below: int | None = None) -> DataFrame:
    """One row with the verdict (``row_count_verdict``)."""
    n = df.agg(F.count(F.lit(1)).alias("actual_count"))
    return n.select(*row_count_verdict(F.col("actual_count"), F.lit(model), F.lit(above), below))


def row_count_failures(df: DataFrame, model: str, above: int = 0, below: int | None = None) -> DataFrame:
    return row_count_check(df, model, above, below).where(F.col("error_type").isNotNull())


# -- singular tests ------------------------------------------------------------------

def duplicate_transactions(unified: DataFrame) -> DataFrame:
    return (
        unified.groupBy("transaction_id")
        .agg(F.count(F.lit(1)).alias("occurrence_count"))
        .where(F.col("occurrence_count") > 1)
    )


def orphan_transactions(transactions: DataFrame, stg_accounts: DataFrame) -> DataFrame:
    """Transactions per account id that has no account (NULL ids count too)."""
    per_account = transactions.groupBy("account_id").agg(F.count(F.lit(1)).alias("orphaned_transactions"))
    return per_account.join(stg_accounts.select("account_id"), "account_id", "left_anti")


def date_spine(start: Column, stop: Column, anchor: DataFrame) -> DataFrame:
    """Every date in [start, stop]; the bounds are expressions over one-row ``anchor``."""
    return anchor.select(F.explode(day_sequence(start, stop)).alias("expected_date"))


def missing_dates(spine: DataFrame, calendar: DataFrame, as_of: dt.date) -> DataFrame:
    """Spine dates up to ``as_of`` that the calendar lacks."""
    have = calendar.select(F.col("utc_date").alias("expected_date"))
    return spine.where(F.col("expected_date") <= F.lit(as_of)).join(have, "expected_date", "left_anti")


def calendar_unique_per_date(calendar: DataFrame) -> DataFrame:
    """Dates carried by more than one calendar row (they multiply enriched rows)."""
    return (
        calendar.groupBy("utc_date").agg(F.count(F.lit(1)).alias("rows_per_date")).where(F.col("rows_per_date") > 1)
    )


# -- table-level gates (freshness, emptiness) --------------------------------------

def table_categories(spark, classes: dict[str, list[str]] = L.TABLE_CLASSES) -> DataFrame:
    rows = [(t, c) for c, tables in classes.items() for t in tables]
    return spark.createDataFrame(rows, "table_name string, category string")


def freshness(
    ingest_log: DataFrame,
    categories: DataFrame,
    as_of: Column | None = None,
    hours: dict[str, int] = L.FRESHNESS_HOURS,
) -> DataFrame:
    """Latest arrival per table vs. the class limit (4 h high, 1 day medium).

    ``ingest_log`` has (table_name, seen_at) rows: times of the tables' own events, or file modification times.
    Ages count from ``as_of``; None: now. A stale or missing high-frequency table is ``critical``; medium is ``warning``.
    """
    now = as_of if as_of is not None else F.current_timestamp()
    last = ingest_log.groupBy("table_name").agg(F.max("seen_at").alias("last_seen"))
    limit = F.lit(None).cast("int")
    for cat, h in hours.items():
        limit = F.when(F.col("category") == cat, F.lit(h)).otherwise(limit)
    tracked = categories.where(F.col("category").isin(list(hours)))
    j = tracked.join(last, "table_name", "left").withColumn("limit_hours", limit)
    # compare instants in epoch seconds: exact, with no daylight-saving arithmetic
    age_seconds = F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col("last_seen").cast("timestamp"))
    fresh = F.coalesce(age_seconds < F.col("limit_hours") * 3600, F.lit(False))
    return j.select(
        "table_name", "category", "last_seen", "limit_hours", fresh.alias("is_fresh"),
        F.when(fresh, "ok").when(F.col("category") == "high_frequency", "critical").otherwise("warning").alias("severity"),
    )


def non_empty(counts: DataFrame, categories: DataFrame, category: str = "low_frequency") -> DataFrame:
    """``counts`` has (table_name, record_count); empty lookup tables are a warning."""
    tracked = categories.where(F.col("category") == category)
    j = tracked.join(counts, "table_name", "left").withColumn(
        "record_count", F.coalesce(F.col("record_count"), F.lit(0)).cast("bigint")
    )
    return j.select(
        "table_name", "category", "record_count",
        (F.col("record_count") > 0).alias("has_data"),
        F.when(F.col("record_count") > 0, "ok").otherwise("warning").alias("severity"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all(
        df.agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(name).alias("table_name"), "record_count")
        for name, df in tables.items()
    )


def validation_summary(fresh: DataFrame, lookups: DataFrame) -> DataFrame:
    """Per class: checked / passing / missing tables (sorted names), and the verdict.

    ``pipeline_fails`` is true on every row when any high-frequency table is stale.
    """
    checks = fresh.select("table_name", "category", F.col("is_fresh").alias("ok"), "severity").unionByName(
        lookups.select("table_name", "category", F.col("has_data").alias("ok"), "severity")
    )
    per_class = checks.groupBy("category").agg(
        F.count(F.lit(1)).alias("checked_count"),
        F.count_if("ok").alias("passed_count"),
        F.count_if(~F.col("ok")).alias("missing_count"),
        F.sort_array(F.collect_list(F.when(~F.col("ok"), F.col("table_name")))).alias("missing_tables"),
        F.bool_or(F.col("severity") == "critical").alias("has_critical"),
    )
    return per_class.select(
        "category", "checked_count", "passed_count", "missing_count",
        F.array_join("missing_tables", ",").alias("missing_tables"),
        F.when(F.col("has_critical"), "critical").when(F.col("missing_count") > 0, "warning").otherwise("ok").alias(
            "severity"
        ),
        # At most one row per table class (3 rows): the global window is trivial.
        F.bool_or("has_critical").over(Window.partitionBy()).alias("pipeline_fails"),
    )
