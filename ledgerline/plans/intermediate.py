"""Intermediate models: unify, enrich, account-month spine and monthly summaries.

Scale notes
* The calendar is broadcast only behind a row-count bound (``sized_broadcast``);
  beyond it the enrichment join shuffles on the date and AQE splits a hot day.
* The spine never forms accounts x months: each account expands only its own
  month range (``explode(sequence)``), then meets the month list by equality.
* Both monthly summaries aggregate transactions per (account, month) with
  map-side partial aggregation before any join, so a hot account is reduced to
  one row per map task before the shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import labels as L
from ledgerline.functions.timeparse import month_sequence
from ledgerline.operators.joins import sized_broadcast
from ledgerline.plans.staging import LOOKUP_MAX_ROWS

UNIFIED_COLUMNS = [
    "transaction_id", "account_id", "transaction_amount", "transaction_requested_at",
    "transaction_completed_at", "transaction_status", "transaction_direction",
]

# Reference defaults are 2020-01-01 and "today"; every call site passes its own.
DEFAULT_START = dt.date(2020, 1, 1)


def _channel(df: DataFrame, channel: str) -> DataFrame:
    d = F.col("transaction_direction")
    prefix = channel
    return df.select(
        *UNIFIED_COLUMNS,
        F.lit(channel).alias("transaction_channel"),
        F.when(d == L.DIRECTION_IN, f"{prefix}_IN").when(d == L.DIRECTION_OUT, f"{prefix}_OUT").alias("transaction_type"),
        "source_table",
    )


def int_unified_transactions(stg_pix: DataFrame, *stg_transfers: DataFrame) -> DataFrame:
    """PIX and the transfer feeds (two tables, or both in one) in one shape (UNION ALL, no dedup)."""
    out = _channel(stg_pix, "PIX")
    for feed in stg_transfers:
        out = out.unionByName(_channel(feed, "TRANSFER"))
    return out


def _size_class(amount: Column) -> Column:
    out = F.lit(L.SIZE_CLASS_ELSE)
    for bound, name in reversed(L.SIZE_CLASSES):
        out = F.when(amount < bound, name).otherwise(out)
    return out


def int_transactions_enriched(unified: DataFrame, calendar: DataFrame, calendar_fits: bool | None = None) -> DataFrame:
    """Left join to the calendar on the completion date; signed amount and classes.

    The calendar is unique per timestamp, not per date: several timestamps on one
    day repeat a transaction once per timestamp (kept, as in the source model).
    ``calendar_fits`` is a broadcast verdict already reached for the calendar.
    """
    cal = sized_broadcast(
        calendar.select(
            F.col("utc_date").alias("cal_date"), "year_number", "month_number", "week_number",
            "weekday_name", "quarter_number", "month_start_date",
        ),
        LOOKUP_MAX_ROWS,
        decided=calendar_fits,
    )
    t = unified.where(F.col("transaction_completed_at").isNotNull()).withColumn(
        "completed_day", F.to_date("transaction_completed_at")
    )
    j = t.join(cal, F.col("completed_day") == F.col("cal_date"), "left")
    amount = F.col("transaction_amount")
    direction = F.col("transaction_direction")
    return j.select(
        "transaction_id", "account_id", "transaction_channel", "transaction_direction", "source_table",
        F.col("year_number").alias("completed_year"),
        F.col("month_number").alias("completed_month_number"),
        F.col("week_number").alias("completed_week"),
        F.col("weekday_name").alias("completed_weekday"),
        F.col("quarter_number").alias("completed_quarter"),
        "transaction_amount",
        F.when(direction == L.DIRECTION_IN, amount)
        .when(direction == L.DIRECTION_OUT, -amount)
        .otherwise(F.lit(0))
        .cast("decimal(18,2)")
        .alias("signed_amount"),
        "transaction_completed_at",
        F.col("cal_date").alias("completed_date"),
        F.col("month_start_date").alias("completed_month_date"),
        F.coalesce(amount >= L.LARGE_TRANSACTION_MIN, F.lit(False)).alias("is_large_transaction"),
        F.lit("BRL").alias("currency_code"),
        _size_class(amount).alias("transaction_size_category"),
    )


def account_date_range(unified: DataFrame) -> DataFrame:
    """First and last completion date per account over all three feeds.

    Reads the unified transactions: they are exactly the three staged feeds, so
    the result equals the per-feed union of the source model, and a run that
    has already written the unified table does not re-scan the raw feeds.
    """
    return (
        unified.where(F.col("transaction_status") == "completed")
        .groupBy("account_id")
        .agg(
            F.min(F.to_date("transaction_completed_at")).alias("first_transaction_date"),
            F.max(F.to_date("transaction_completed_at")).alias("last_transaction_date"),
        )
    )


def int_account_monthly_spine(
    stg_accounts: DataFrame,
    calendar: DataFrame,
    unified: DataFrame,
    as_of: dt.date,
    default_start: dt.date = DEFAULT_START,
    calendar_fits: bool | None = None,
) -> DataFrame:
    """Every active account x every calendar month inside its activity range.

    Range = [month of first transaction, month of last transaction], or
    [default_start, as_of] for accounts without transactions. Each account
    expands only its own months (no accounts x months cross product); the month
    list is bounded by the calendar and broadcast behind a size check.
    """
    accounts = _spine_accounts(stg_accounts)
    months = _calendar_months(calendar, calendar_fits)
    per_account = accounts.join(account_date_range(unified), "account_id", "left").select(
        "account_id", F.explode(_own_months(default_start, as_of)).alias("month_date")
    )
    return per_account.join(months, "month_date", "inner").select("account_id", "year", "month", "month_date")


def _spine_accounts(stg_accounts: DataFrame) -> DataFrame:
    return stg_accounts.where(F.col("account_status") == "active").select("account_id").distinct()


def _calendar_months(calendar: DataFrame, calendar_fits: bool | None) -> DataFrame:
    listed = calendar.where(F.col("month_start_date").isNotNull()).select(
        F.col("month_start_date").alias("month_date"), F.col("year_number").alias("year"), F.col("month_number").alias("month")
    )
    return sized_broadcast(listed.distinct(), LOOKUP_MAX_ROWS, decided=calendar_fits)


def _own_months(default_start: dt.date, as_of: dt.date) -> Column:
    """The months of an account's activity range, or of the default range without transactions."""
    lo = F.coalesce(F.trunc("first_transaction_date", "MM"), F.lit(default_start))
    hi = F.coalesce(F.trunc("last_transaction_date", "MM"), F.lit(as_of))
    return month_sequence(lo, hi)


def on_own_months(
    stg_accounts: DataFrame,
    calendar: DataFrame,
    per_month: DataFrame,
    as_of: dt.date,
    default_start: dt.date = DEFAULT_START,
    calendar_fits: bool | None = None,
) -> DataFrame:
    """The spine with each month's measures, from one pass over the facts.

    ``per_month`` has account_id, month_date, first_day, last_day and measures, one row per account and month. The
    account's date range comes from the same rows, and its months travel as one map (at most one entry per month) to the
    account, where the spine's months look themselves up: the spine itself is never shuffled. Rows without a month only
    widen the range.
    """
    return expand_months(accounts_with_months(stg_accounts, per_month), calendar, as_of, default_start, calendar_fits)


def accounts_with_months(stg_accounts: DataFrame, per_month: DataFrame) -> DataFrame:
    """One row per spine account: its date range and the map of its months' measures (null without transactions)."""
    measures = [c for c in per_month.columns if c not in ("account_id", "month_date", "first_day", "last_day")]
    entry = F.struct("month_date", F.struct(*measures).alias("m"))
    per_account = per_month.groupBy("account_id").agg(
        F.min("first_day").alias("first_transaction_date"),
        F.max("last_day").alias("last_transaction_date"),
        F.map_from_entries(F.collect_list(F.when(F.col("month_date").isNotNull(), entry))).alias("months"),
    )
    return _spine_accounts(stg_accounts).join(per_account, "account_id", "left")


def expand_months(
    own: DataFrame, calendar: DataFrame, as_of: dt.date, default_start: dt.date = DEFAULT_START, calendar_fits: bool | None = None
) -> DataFrame:
    """``accounts_with_months`` -> one row per account and month, an account's months in ascending order. Nothing is
    shuffled while the calendar is broadcast."""
    measures = own.schema["months"].dataType.valueType.names
    found = lambda d: F.struct(d.alias("month_date"), F.try_element_at(F.col("months"), d).alias("m"))
    rows = own.select("account_id", F.inline(F.transform(_own_months(default_start, as_of), found)))
    j = rows.join(_calendar_months(calendar, calendar_fits), "month_date", "inner")
    return j.select("account_id", "year", "month", "month_date", *[F.col(f"m.{c}").alias(c) for c in measures])


def _monthly_measures(direction_in: str, direction_out: str) -> list[Column]:
    d, ch = F.col("transaction_direction"), F.col("transaction_channel")
    amount, signed = F.col("transaction_amount"), F.col("signed_amount")
    return [
        F.sum(F.when(d == direction_in, amount).otherwise(0)).alias("inbound_volume"),
        F.sum(F.when(d == direction_out, amount).otherwise(0)).alias("outbound_volume"),
        F.sum(signed).alias("net_flow"),
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(d == direction_in).alias("inbound_transactions"),
        F.count_if(d == direction_out).alias("outbound_transactions"),
        F.sum(F.when(ch == "PIX", signed).otherwise(0)).alias("pix_net_flow"),
        F.sum(F.when(ch == "TRANSFER", signed).otherwise(0)).alias("transfer_net_flow"),
        F.count_if(ch == "PIX").alias("pix_transactions"),
        F.count_if(ch == "TRANSFER").alias("transfer_transactions"),
        F.avg(F.when(d == direction_in, amount)).alias("avg_inbound_transaction_amount"),
        F.avg(F.when(d == direction_out, amount)).alias("avg_outbound_transaction_amount"),
    ]


ZERO_FILLED = [
    "inbound_volume", "outbound_volume", "net_flow", "total_transactions", "inbound_transactions",
    "outbound_transactions", "pix_net_flow", "transfer_net_flow", "pix_transactions", "transfer_transactions",
]


def _days() -> list[Column]:
    day = F.to_date("transaction_completed_at")
    return [F.min(day).alias("first_day"), F.max(day).alias("last_day")]


def monthly_measures(enriched: DataFrame) -> DataFrame:
    """Measures and first / last day per (account, month of the completion time, not the calendar's)."""
    done = enriched.where(F.col("transaction_completed_at").isNotNull())
    return (
        done.withColumn("month_date", F.trunc("transaction_completed_at", "MM"))
        .groupBy("account_id", "month_date")
        .agg(*_days(), *_monthly_measures(L.DIRECTION_IN, L.DIRECTION_OUT))
    )


def monthly_summary(on_spine: DataFrame) -> DataFrame:
    """``int_monthly_transaction_summary`` from the spine with its measures: gaps become zeros."""
    filled = [F.coalesce(F.col(c), F.lit(0)).cast(on_spine.schema[c].dataType).alias(c) for c in ZERO_FILLED]
    return on_spine.select(
        "account_id", "year", "month", *filled,
        "avg_inbound_transaction_amount", "avg_outbound_transaction_amount", "month_date",
        F.coalesce(F.col("total_transactions") > 0, F.lit(False)).alias("has_activity"),
    )


def int_monthly_transaction_summary(spine: DataFrame, enriched: DataFrame) -> DataFrame:
    """Per (account, month) measures on a given spine, gaps filled with zeros."""
    return monthly_summary(spine.join(monthly_measures(enriched).drop("first_day", "last_day"), ["account_id", "month_date"], "left"))


SUMMARY_ZERO = [
    "inbound_volume", "outbound_volume", "net_flow", "total_transactions", "inbound_transactions",
    "outbound_transactions", "pix_net_flow", "transfer_net_flow", "pix_transactions", "transfer_transactions",
    "micro_transactions", "small_transactions", "medium_transactions", "large_transactions",
]


def summary_measures(enriched: DataFrame, direction_in: str = L.DIRECTION_IN, direction_out: str = L.DIRECTION_OUT) -> DataFrame:
    """Measures and first / last day per (account, calendar month); days missing in the calendar have no month."""
    d, ch = F.col("transaction_direction"), F.col("transaction_channel")
    amount, signed, size = F.col("transaction_amount"), F.col("signed_amount"), F.col("transaction_size_category")
    return enriched.groupBy("account_id", F.col("completed_month_date").alias("month_date")).agg(
        *_days(),
        F.sum(F.when(d == direction_in, amount)).alias("inbound_volume"),
        F.sum(F.when(d == direction_out, amount)).alias("outbound_volume"),
        F.sum(signed).alias("net_flow"),
        F.count("transaction_id").alias("total_transactions"),
        F.count_if(d == direction_in).alias("inbound_transactions"),
        F.count_if(d == direction_out).alias("outbound_transactions"),
        F.sum(F.when(ch == "PIX", signed)).alias("pix_net_flow"),
        F.sum(F.when(ch == "TRANSFER", signed)).alias("transfer_net_flow"),
        F.count_if(ch == "PIX").alias("pix_transactions"),
        F.count_if(ch == "TRANSFER").alias("transfer_transactions"),
        *[F.count_if(size == k).alias(f"{k}_transactions") for k in ("micro", "small", "medium", "large")],
        F.avg(F.when(d == direction_in, amount)).alias("avg_inbound_amount"),
        F.avg(F.when(d == direction_out, amount)).alias("avg_outbound_amount"),
    )


def transactions_summary(on_spine: DataFrame) -> DataFrame:
    """``int_transactions_summary`` from the spine with its measures."""
    return on_spine.select(
        "account_id", "month_date", "year", "month",
        *[F.coalesce(F.col(c), F.lit(0)).cast(on_spine.schema[c].dataType).alias(c) for c in SUMMARY_ZERO],
        "avg_inbound_amount", "avg_outbound_amount",
    )


def int_transactions_summary(
    spine: DataFrame,
    enriched: DataFrame,
    direction_in: str = L.DIRECTION_IN,
    direction_out: str = L.DIRECTION_OUT,
) -> DataFrame:
    """A given spine left-joined to transactions by the calendar's month, then aggregated.

    Written as aggregate-then-join: the spine is unique per (account, month,
    year, month number), so per-key partial sums joined once equal the
    join-then-aggregate result, while the shuffle carries one row per key.
    ``direction_in/out`` default to the staged labels; the reference compares
    with ``TRANSFER_IN`` / ``TRANSFER_out`` (pass those to reproduce it).
    """
    keyed = F.col("account_id").isNotNull() & F.col("completed_month_date").isNotNull()
    per_key = summary_measures(enriched.where(keyed), direction_in, direction_out).drop("first_day", "last_day")
    return transactions_summary(spine.join(per_key, ["account_id", "month_date"], "left"))
