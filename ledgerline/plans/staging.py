"""Staging and base models: scan -> filter -> project -> normalise.

Each function maps raw DataFrames to a model DataFrame. They are stateless and
work unchanged on streaming DataFrames (except the two joins in the base models).
Metadata columns (``_loaded_at``) are added at materialization, not here, so
model output stays deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import labels as L
from ledgerline.functions.timeparse import parse_ts_of, with_parsed_ts
from ledgerline.operators.joins import sized_broadcast

# Upper bound for broadcasting a calendar or location lookup.
LOOKUP_MAX_ROWS = 200_000


def stg_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.where(F.col("account_id").isNotNull()).select(
        "account_id",
        "account_name",
        F.col("created_at").alias("account_created_at"),
        F.col("status").alias("account_status"),
        F.lit("accounts").alias("source_table"),
    )


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.where(F.col("customer_id").isNotNull()).select(
        "customer_id", "first_name", "last_name", "customer_city", "cpf", "country_name",
        F.lit("customers").alias("source_table"),
    )


def _direction_from_type(raw: Column) -> Column:
    norm = F.lower(F.trim(raw))
    return F.when(norm == "pix_in", L.DIRECTION_IN).when(norm == "pix_out", L.DIRECTION_OUT).otherwise("unknown")


def _completion_parts(df: DataFrame) -> list[Column]:
    """Year and month of the already-parsed completion time (parsed once, referenced here)."""
    done = F.col("transaction_completed_at")
    return [F.year(done).alias("completed_year"), F.month(done).alias("completed_month")]


def stg_pix_movements(pix: DataFrame, auto_scale: bool = False) -> DataFrame:
    parsed = pix.where(F.col("status") == "completed").select(
        F.col("id").alias("transaction_id"),
        "account_id",
        F.col("pix_amount").alias("transaction_amount"),
        parse_ts_of(pix, "pix_requested_at", auto_scale).alias("transaction_requested_at"),
        parse_ts_of(pix, "pix_completed_at", auto_scale).alias("transaction_completed_at"),
        "status",
        "in_or_out",
    )
    return parsed.select(
        "transaction_id", "account_id", "transaction_amount", "transaction_requested_at", "transaction_completed_at",
        *_completion_parts(parsed),
        "status",
        F.col("in_or_out").alias("transaction_type"),
        F.lower(F.trim(F.col("status"))).alias("transaction_status"),
        _direction_from_type(F.col("in_or_out")).alias("transaction_direction"),
        F.lit("pix_movements").alias("source_table"),
    )


def stg_transfers(transfers: DataFrame, direction: Column, source_table: Column, auto_scale: bool = False) -> DataFrame:
    """Shared body of ``stg_transfer_ins`` / ``stg_transfer_outs``.

    Completion time is epoch-second text in the external-table load and a real
    timestamp in the pipe load; the parser accepts both and never raises, so the
    cast cannot fail on rows the status filter would drop. It runs once per row.
    """
    completed = transfers.where(F.col("status") == "completed").select(
        F.col("id").alias("transaction_id"),
        "account_id",
        F.col("amount").alias("transaction_amount"),
        # no model filters or joins on it, so where it is unused it isn't parsed at all
        parse_ts_of(transfers, "transaction_requested_at", auto_scale).alias("transaction_requested_at"),
        "transaction_completed_at",
        "status",
        direction.alias("transaction_direction"),
        source_table.alias("source_table"),
    )
    parsed = with_parsed_ts(completed, "transaction_completed_at", auto_scale)
    return parsed.select(
        "transaction_id", "account_id", "transaction_amount", "transaction_requested_at", "transaction_completed_at",
        *_completion_parts(parsed),
        F.lower(F.trim(F.col("status"))).alias("transaction_status"),
        "transaction_direction",
        "source_table",
    )


def stg_transfer_ins(transfer_ins: DataFrame, auto_scale: bool = False) -> DataFrame:
    return stg_transfers(transfer_ins, F.lit(L.DIRECTION_IN), F.lit("transfer_ins"), auto_scale)


def stg_transfer_outs(transfer_outs: DataFrame, auto_scale: bool = False) -> DataFrame:
    return stg_transfers(transfer_outs, F.lit(L.DIRECTION_OUT), F.lit("transfer_outs"), auto_scale)


def stg_both_transfers(transfers: DataFrame, auto_scale: bool = False) -> DataFrame:
    """Both feeds staged from one table with a ``feed`` column: the union of the two models in one pass."""
    is_in = F.col("feed") == "in"
    direction = F.when(is_in, L.DIRECTION_IN).otherwise(L.DIRECTION_OUT)
    return stg_transfers(transfers, direction, F.when(is_in, "transfer_ins").otherwise("transfer_outs"), auto_scale)


def base_location_hierarchy(
    city: DataFrame, state: DataFrame, country: DataFrame, lookup_rows: dict[str, int | None] | None = None
) -> DataFrame:
    bounds = lookup_rows or {}
    s = sized_broadcast(state.select("state_id", "state", "country_id"), LOOKUP_MAX_ROWS, known_rows=bounds.get("state"))
    co = sized_broadcast(country.select("country_id", "country"), LOOKUP_MAX_ROWS, known_rows=bounds.get("country"))
    joined = (
        city.alias("c")
        .join(s.alias("s"), F.col("c.state_id") == F.col("s.state_id"), "left")
        .join(co.alias("co"), F.col("s.country_id") == F.col("co.country_id"), "left")
    )
    iso2 = F.lit(None).cast("string")
    for name, code in reversed(list(L.COUNTRY_ISO2.items())):
        iso2 = F.when(F.col("co.country") == name, code).otherwise(iso2)
    return joined.select(
        F.col("c.city_id").alias("location_id"),
        F.col("c.city_name").alias("city"),
        F.col("c.state_id").alias("state_id"),
        F.col("s.state").alias("state"),
        F.col("s.country_id").alias("country_id"),
        F.col("co.country").alias("country"),
        iso2.alias("country_iso2"),
        F.concat(F.col("co.country"), F.lit(" > "), F.col("s.state"), F.lit(" > "), F.col("c.city_name")).alias(
            "full_location_path"
        ),
    )


def _month_name(month_number: Column) -> Column:
    out = F.lit(None).cast("string")
    for i, name in reversed(list(enumerate(L.MONTH_NAMES, start=1))):
        out = F.when(month_number == i, name).otherwise(out)
    return out


def base_time_dimension(
    d_time: DataFrame,
    d_week: DataFrame,
    d_month: DataFrame,
    d_year: DataFrame,
    d_weekday: DataFrame,
    lookup_rows: dict[str, int | None] | None = None,
) -> DataFrame:
    """Calendar with ~30 derived attributes; only rows with a parseable timestamp.

    ``lookup_rows`` gives proven row bounds of the four lookups by table name
    (``d_week`` ...); lookups without one are size-checked before broadcasting.
    """
    bounds = lookup_rows or {}
    parsed = d_time.select(
        "time_id", "week_id", "month_id", "year_id", "weekday_id", "action_timestamp",
        parse_ts_of(d_time, "action_timestamp").alias("ts"),
    ).where(F.col("action_timestamp").isNotNull() & F.col("time_id").isNotNull() & F.col("ts").isNotNull())

    def lookup(df: DataFrame, table: str, key: str, value: str, alias: str) -> DataFrame:
        pairs = df.select(F.col(key).alias(f"{alias}_key"), F.col(value).alias(alias))
        return sized_broadcast(pairs, LOOKUP_MAX_ROWS, known_rows=bounds.get(table))

    t = (
        parsed.join(lookup(d_week, "d_week", "week_id", "action_week", "week_number"), F.col("week_id") == F.col("week_number_key"), "left")
        .join(lookup(d_month, "d_month", "month_id", "action_month", "month_number"), F.col("month_id") == F.col("month_number_key"), "left")
        .join(lookup(d_year, "d_year", "year_id", "action_year", "year_number"), F.col("year_id") == F.col("year_number_key"), "left")
        .join(
            lookup(d_weekday, "d_weekday", "weekday_id", "action_weekday", "weekday_name"),
            F.col("weekday_id") == F.col("weekday_name_key"),
            "left",
        )
    )
    ts = F.col("ts")
    is_weekday = F.when(F.col("weekday_name").isin(L.WEEKEND_DAYS), False).otherwise(True)
    quarter = F.quarter(ts)
    day = F.dayofmonth(ts)
    mid = t.select(
        "time_id", "week_id", "month_id", "year_id", "weekday_id", "weekday_name",
        "week_number", "month_number", "year_number", "ts",
        quarter.alias("quarter_number"),
        day.alias("day_of_month"),
        F.dayofyear(ts).alias("day_of_year"),
        F.weekofyear(ts).alias("week_of_year"),
        is_weekday.alias("is_weekday"),
        F.coalesce(F.col("month_number").isin(L.SUMMER_MONTHS), F.lit(False)).alias("is_summer_brazil"),
        F.coalesce(F.col("month_number").isin(L.WINTER_MONTHS), F.lit(False)).alias("is_winter_brazil"),
        F.coalesce(day == 1, F.lit(False)).alias("is_month_start"),
        F.coalesce(F.dayofmonth(F.last_day(ts)) == day, F.lit(False)).alias("is_month_end"),
    )
    q = F.col("quarter_number")
    return mid.select(
        "time_id", "week_id", "month_id", "year_id", "weekday_id", "weekday_name",
        _month_name(F.col("month_number")).alias("month_name"),
        F.when(q == 1, "Q1").when(q == 2, "Q2").when(q == 3, "Q3").when(q == 4, "Q4").alias("quarter_name"),
        F.when(F.col("weekday_name") == "Monday", "week_start")
        .when(F.col("weekday_name") == "Friday", "week_end")
        .when(~F.col("is_weekday"), "weekend")
        .otherwise("weekday")
        .alias("business_day_type"),
        "week_number", "month_number", "year_number", "quarter_number", "day_of_month", "day_of_year",
        "week_of_year",
        F.col("year_number").alias("fiscal_year"),
        F.concat(
            F.col("year_number").cast("string"), F.lit("-"), F.lpad(F.col("month_number").cast("string"), 2, "0")
        ).alias("year_month"),
        F.concat(F.col("year_number").cast("string"), F.lit("-Q"), q.cast("string")).alias("year_quarter"),
        F.concat(
            F.col("year_number").cast("string"), F.lit("-W"), F.lpad(F.col("week_number").cast("string"), 2, "0")
        ).alias("year_week"),
        F.col("ts").alias("utc_timestamp"),
        F.to_date("ts").alias("utc_date"),
        F.trunc("ts", "MM").alias("month_start_date"),
        F.trunc(F.to_date("ts"), "week").alias("week_start_date"),
        F.trunc("ts", "year").alias("year_start_date"),
        F.trunc("ts", "quarter").alias("quarter_start_date"),
        "is_weekday", "is_summer_brazil", "is_winter_brazil", "is_month_start", "is_month_end",
    )
