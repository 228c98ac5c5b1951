"""Marts: dimensions, facts and the two reports.

``as_of`` replaces ``CURRENT_DATE()`` so results are reproducible. Ratios and
percentages are computed in exact decimal arithmetic (``div_half_up``) instead
of floating point, so they round half-up exactly once.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import labels as L
from ledgerline.functions.decimals import div_half_up

MONEY_SUM = "decimal(28,2)"


def _banded(value: Column, bands: list[tuple[float, str]], otherwise: str, inclusive: bool = False) -> Column:
    out = F.lit(otherwise)
    for bound, name in reversed(bands):
        cond = value <= bound if inclusive else value < bound
        out = F.when(cond, name).otherwise(out)
    return out


# -- dim_account -----------------------------------------------------------------

def account_activity(enriched: DataFrame) -> DataFrame:
    """Lifetime activity per account.

    The active days are exact mergeable sets: one bit per day of a month, or-ed map-side. So what is shuffled is one row
    per account, month and task, where a distinct count would send one per account and day.
    """
    done = F.col("transaction_completed_at")
    months = enriched.groupBy("account_id", F.trunc(done, "MM").alias("month")).agg(
        F.min(done).alias("first"),
        F.max(done).alias("last"),
        F.count(F.lit(1)).alias("n"),
        F.sum("transaction_amount").alias("volume"),
        F.bit_or(F.call_function("shiftleft", F.lit(1), F.dayofmonth(done) - 1)).alias("days"),
    )
    return months.groupBy("account_id").agg(
        F.min("first").alias("first_transaction_date"),
        F.max("last").alias("last_transaction_date"),
        F.sum("n").alias("total_lifetime_transactions"),
        F.sum("volume").cast("decimal(28,2)").alias("total_lifetime_volume"),
        F.coalesce(F.sum(F.bit_count("days")), F.lit(0)).cast("bigint").alias("active_days"),
    )


def dim_account(stg_accounts: DataFrame, enriched: DataFrame, as_of: dt.date) -> DataFrame:
    a = stg_accounts.where(F.col("account_id").isNotNull())
    return account_dimension(a.join(account_activity(enriched), "account_id", "left"), as_of)


def account_dimension(j: DataFrame, as_of: dt.date) -> DataFrame:
    """``dim_account`` from the accounts with their activity (null without transactions)."""
    today = F.lit(as_of)
    age = F.datediff(today, F.to_date("account_created_at"))
    txns = F.coalesce(F.col("total_lifetime_transactions"), F.lit(0))
    volume = F.coalesce(F.col("total_lifetime_volume"), F.lit(0)).cast(MONEY_SUM)
    recent_cutoff = F.date_sub(today, L.RECENT_ACTIVITY_DAYS).cast("timestamp_ntz")
    return j.select(
        "account_id", "account_name", "account_status", "account_created_at",
        "first_transaction_date", "last_transaction_date",
        txns.cast("bigint").alias("total_lifetime_transactions"),
        volume.alias("total_lifetime_volume"),
        F.coalesce(F.col("active_days"), F.lit(0)).cast("bigint").alias("active_days"),
        age.alias("account_age_days"),
        _banded(age, L.AGE_SEGMENTS, L.AGE_SEGMENT_ELSE).alias("account_age_segment"),
        _banded(txns, L.ACTIVITY_SEGMENTS, L.ACTIVITY_SEGMENT_ELSE, inclusive=True).alias("activity_segment"),
        F.when(volume == 0, L.VALUE_TIER_ZERO)
        .otherwise(_banded(volume, L.VALUE_TIERS, L.VALUE_TIER_ELSE))
        .alias("value_tier"),
        F.coalesce(F.col("account_status") == "active", F.lit(False)).alias("is_active"),
        F.col("first_transaction_date").isNotNull().alias("has_transactions"),
        F.coalesce(F.col("last_transaction_date") >= recent_cutoff, F.lit(False)).alias("is_recently_active"),
        F.coalesce(age <= L.NEW_ACCOUNT_DAYS, F.lit(False)).alias("is_new_account"),
        "source_table",
    )


# -- dim_calendar ----------------------------------------------------------------

def dim_calendar(base_time: DataFrame) -> DataFrame:
    m = F.col("month_number")
    season = (
        F.when(m.isin(L.SUMMER_MONTHS), "Summer")
        .when(m.isin(L.AUTUMN_MONTHS), "Autumn")
        .when(m.isin(L.WINTER_MONTHS), "Winter")
        .otherwise("Spring")
    )
    return base_time.select(
        "time_id", "utc_timestamp", "utc_date",
        F.col("year_number").alias("year"),
        F.col("month_number").alias("month"),
        F.col("week_number").alias("week"),
        F.col("weekday_name").alias("weekday"),
        F.col("quarter_number").alias("quarter"),
        "month_start_date", "week_start_date",
        F.when(F.col("weekday_name").isin(L.WEEKEND_DAYS), False).otherwise(True).alias("is_weekday"),
        season.alias("season_southern_hemisphere"),
    )


# -- dim_customer ----------------------------------------------------------------

def dim_customer(stg_customers: DataFrame) -> DataFrame:
    first, last = F.col("first_name"), F.col("last_name")
    name_len = F.length(first) + F.length(last)
    city_text = F.col("customer_city").cast("string")
    cpf_text = F.col("cpf").cast("string")
    return stg_customers.where(F.col("customer_id").isNotNull()).select(
        "customer_id", "cpf", "first_name", "last_name",
        F.concat(first, F.lit(" "), last).alias("full_name"),
        "customer_city", "country_name",
        F.when(name_len > L.NAME_LONG_OVER, "Long Name")
        .when(name_len > L.NAME_MEDIUM_OVER, "Medium Name")
        .otherwise("Short Name")
        .alias("name_length_category"),
        F.upper(F.trim(city_text)).alias("city_normalized"),
        F.upper(F.trim(F.col("country_name"))).alias("country_normalized"),
        (first.isNotNull() & last.isNotNull()).alias("has_complete_name"),
        F.col("customer_city").isNotNull().alias("has_city_info"),
        F.coalesce(F.col("cpf").isNotNull() & (F.length(cpf_text) == L.CPF_LENGTH), F.lit(False)).alias("has_valid_cpf"),
        "source_table",
    )


# -- fct_transactions ------------------------------------------------------------

def fct_transactions(
    enriched: DataFrame, direction_in: str = L.DIRECTION_IN, direction_out: str = L.DIRECTION_OUT
) -> DataFrame:
    """Positive, complete transactions with per-direction and per-channel amounts.

    The reference tests the direction against ``TRANSFER_IN``/``TRANSFER_OUT``,
    which never occur; pass those labels to reproduce its always-zero columns.
    """
    amount = F.col("transaction_amount")
    zero = F.lit(0).cast("decimal(18,2)")
    kept = enriched.where(
        F.col("transaction_id").isNotNull()
        & F.col("account_id").isNotNull()
        & (amount > 0)
        & F.col("transaction_completed_at").isNotNull()
    )
    return kept.select(
        "transaction_id", "account_id", "transaction_channel", "transaction_direction",
        "transaction_size_category", "source_table", "completed_year", "completed_month_number",
        "completed_week", "completed_weekday", "completed_quarter", "transaction_amount", "signed_amount",
        "transaction_completed_at", "completed_date", "completed_month_date", "is_large_transaction",
        "currency_code",
        F.when(F.col("transaction_direction") == direction_in, amount).otherwise(zero).alias("inbound_amount"),
        F.when(F.col("transaction_direction") == direction_out, amount).otherwise(zero).alias("outbound_amount"),
        F.when(F.col("transaction_channel") == "PIX", amount).otherwise(zero).alias("pix_amount"),
        F.when(F.col("transaction_channel") == "TRANSFER", amount).otherwise(zero).alias("transfer_amount"),
    )


# -- fct_account_monthly_balances ------------------------------------------------

def fct_account_monthly_balances(summary: DataFrame) -> DataFrame:
    inbound, outbound = F.col("inbound_volume"), F.col("outbound_volume")
    total = F.col("total_transactions")
    pix, transfer = F.col("pix_transactions"), F.col("transfer_transactions")
    kept = summary.where(F.col("account_id").isNotNull() & F.col("month_date").isNotNull())
    return kept.select(
        "account_id", "year", "month", "inbound_volume", "outbound_volume", "net_flow",
        "total_transactions", "inbound_transactions", "outbound_transactions", "pix_net_flow",
        "transfer_net_flow", "pix_transactions", "transfer_transactions",
        "avg_inbound_transaction_amount", "avg_outbound_transaction_amount", "month_date", "has_activity",
        F.coalesce(inbound > outbound, F.lit(False)).alias("is_net_positive"),
        F.coalesce(total >= L.HIGH_ACTIVITY_MIN_TRANSACTIONS, F.lit(False)).alias("is_high_activity"),
        F.coalesce(pix > transfer, F.lit(False)).alias("prefers_pix"),
        F.when(outbound > 0, div_half_up(inbound, outbound, 2, num_scale=2, den_scale=2)).alias(
            "inbound_outbound_ratio"
        ),
        _banded(total, L.ACTIVITY_LEVELS, L.ACTIVITY_LEVEL_ELSE, inclusive=True).alias("activity_level"),
        F.when((pix == 0) & (transfer == 0), L.CHANNEL_NONE)
        .when(pix > transfer, L.CHANNEL_PIX)
        .when(transfer > pix, L.CHANNEL_TRANSFER)
        .otherwise(L.CHANNEL_MIXED)
        .alias("channel_preference"),
    )


# -- report_monthly_business_kpi -------------------------------------------------

KPI_COLUMNS = [
    "report_month", "year", "month", "total_active_accounts", "active_accounts", "high_activity_accounts",
    "account_activation_rate_pct", "total_inbound_volume", "total_outbound_volume", "total_net_flow",
    "inflow_outflow_ratio", "total_transactions", "total_pix_transactions", "total_transfer_transactions",
    "pix_adoption_rate_pct", "avg_inbound_amount", "avg_outbound_amount", "total_pix_flow",
    "total_transfer_flow", "pix_volume_share_pct", "prev_month_inbound_volume", "prev_month_transactions",
]


def monthly_kpis(balances: DataFrame, unique_account_months: bool = False) -> DataFrame:
    """Per-month aggregates without Spark's distinct-aggregate expansion.

    ``unique_account_months=True`` (the model graph: the spine makes balances
    unique per account and month, so an account appears at most once in each
    month group): distinct counts equal conditional counts, and everything is
    one aggregation with map-side partial aggregation. Its shuffle is about one row per
    month per map task, whatever the input's partitioning.

    Otherwise, for arbitrary input, two levels are used instead of three COUNT(DISTINCT)s:

    Level 1 groups by (account, month) - the grain the balances already have, so
    it reuses their partitioning - and keeps per-account flags and partial sums.
    Level 2 groups by month: a distinct account count is then a plain count.
    This avoids the 4x row expansion Spark uses for several distinct aggregates.
    The average of averages is sum / count, rounded half-up once at scale 10
    (the scale ``AVG`` of a decimal(22,6) has), then to 2 digits.
    """
    keys = [F.col("month_date").alias("report_month"), "year", "month"]
    if unique_account_months:
        has_id = F.col("account_id").isNotNull()
        return balances.where(F.col("month_date").isNotNull()).groupBy(*keys).agg(
            F.count("account_id").alias("total_active_accounts"),
            F.count_if(has_id & F.col("has_activity")).alias("active_accounts"),
            F.count_if(has_id & F.col("is_high_activity")).alias("high_activity_accounts"),
            F.sum("inbound_volume").cast("decimal(38,2)").alias("total_inbound_volume"),
            F.sum("outbound_volume").cast("decimal(38,2)").alias("total_outbound_volume"),
            F.sum("net_flow").cast("decimal(38,2)").alias("total_net_flow"),
            F.sum("total_transactions").alias("total_transactions"),
            F.sum("pix_transactions").alias("total_pix_transactions"),
            F.sum("transfer_transactions").alias("total_transfer_transactions"),
            F.sum("avg_inbound_transaction_amount").alias("avg_in_sum"),
            F.count("avg_inbound_transaction_amount").alias("avg_in_n"),
            F.sum("avg_outbound_transaction_amount").alias("avg_out_sum"),
            F.count("avg_outbound_transaction_amount").alias("avg_out_n"),
            F.sum("pix_net_flow").cast("decimal(38,2)").alias("total_pix_flow"),
            F.sum("transfer_net_flow").cast("decimal(38,2)").alias("total_transfer_flow"),
        )
    per_account = (
        balances.where(F.col("month_date").isNotNull())
        .groupBy("account_id", *keys)
        .agg(
            F.bool_or("has_activity").alias("any_activity"),
            F.bool_or("is_high_activity").alias("any_high_activity"),
            F.sum("inbound_volume").alias("inbound_volume"),
            F.sum("outbound_volume").alias("outbound_volume"),
            F.sum("net_flow").alias("net_flow"),
            F.sum("total_transactions").alias("total_transactions"),
            F.sum("pix_transactions").alias("pix_transactions"),
            F.sum("transfer_transactions").alias("transfer_transactions"),
            F.sum("avg_inbound_transaction_amount").alias("avg_in_sum"),
            F.count("avg_inbound_transaction_amount").alias("avg_in_n"),
            F.sum("avg_outbound_transaction_amount").alias("avg_out_sum"),
            F.count("avg_outbound_transaction_amount").alias("avg_out_n"),
            F.sum("pix_net_flow").alias("pix_net_flow"),
            F.sum("transfer_net_flow").alias("transfer_net_flow"),
        )
    )
    has_id = F.col("account_id").isNotNull()
    return per_account.groupBy("report_month", "year", "month").agg(
        F.count("account_id").alias("total_active_accounts"),
        F.count_if(has_id & F.col("any_activity")).alias("active_accounts"),
        F.count_if(has_id & F.col("any_high_activity")).alias("high_activity_accounts"),
        F.sum("inbound_volume").alias("total_inbound_volume"),
        F.sum("outbound_volume").alias("total_outbound_volume"),
        F.sum("net_flow").alias("total_net_flow"),
        F.sum("total_transactions").alias("total_transactions"),
        F.sum("pix_transactions").alias("total_pix_transactions"),
        F.sum("transfer_transactions").alias("total_transfer_transactions"),
        F.sum("avg_in_sum").alias("avg_in_sum"),
        F.sum("avg_in_n").alias("avg_in_n"),
        F.sum("avg_out_sum").alias("avg_out_sum"),
        F.sum("avg_out_n").alias("avg_out_n"),
        F.sum("pix_net_flow").alias("total_pix_flow"),
        F.sum("transfer_net_flow").alias("total_transfer_flow"),
    )


def monthly_distinct_accounts(balances: DataFrame) -> DataFrame:
    """The report's three distinct account counts per month, for balances that may repeat an account in a month.

    Accounts are bits of exact bitmaps (32,768 ids each), built and or-ed map-side per (month, bitmap), so the shuffle
    holds at most one row per month and bitmap from each task, however many rows or repeats an account has. Made for ids
    that lie close together (a dimension's running numbers): ids far apart cost a bitmap of 4 KB each, where the two
    levels of ``monthly_kpis`` send a row.
    """
    keys = [F.col("month_date").alias("report_month"), "year", "month"]
    at = F.bitmap_bit_position("account_id")
    rows = balances.where(F.col("month_date").isNotNull())
    bitmaps = rows.where(F.col("account_id").isNotNull()).groupBy(*keys, F.bitmap_bucket_number("account_id").alias("bitmap")).agg(
        F.bitmap_construct_agg(at).alias("every"),
        F.bitmap_construct_agg(F.when(F.col("has_activity"), at)).alias("active"),
        F.bitmap_construct_agg(F.when(F.col("is_high_activity"), at)).alias("high"),
    )
    count = lambda c, name: F.coalesce(F.sum(F.bitmap_count(c)), F.lit(0)).alias(name)
    counted = bitmaps.groupBy("report_month", "year", "month").agg(
        count("every", "total_active_accounts"), count("active", "active_accounts"), count("high", "high_activity_accounts")
    )
    # months whose rows have no account at all are months of the report too
    months = rows.select(*keys).distinct()
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"c.{c}")) for c in ("report_month", "year", "month")]
    joined = months.alias("m").join(counted.alias("c"), same[0] & same[1] & same[2], "left")
    zero = lambda c: F.coalesce(F.col(f"c.{c}"), F.lit(0)).cast("bigint").alias(c)
    return joined.select("m.report_month", "m.year", "m.month", zero("total_active_accounts"), zero("active_accounts"), zero("high_activity_accounts"))


def _avg_of_avgs(total: Column, n: Column) -> Column:
    avg10 = F.when(n > 0, div_half_up(total, n, 10, num_scale=6))
    return F.when(n > 0, div_half_up(avg10, F.lit(1), 2, num_scale=10))


def report_monthly_business_kpi(balances: DataFrame, unique_account_months: bool = False) -> DataFrame:
    k = monthly_kpis(balances, unique_account_months)
    accounts, active = F.col("total_active_accounts"), F.col("active_accounts")
    tx, pix_tx = F.col("total_transactions"), F.col("total_pix_transactions")
    inbound, outbound = F.col("total_inbound_volume"), F.col("total_outbound_volume")
    pix_flow, transfer_flow = F.col("total_pix_flow"), F.col("total_transfer_flow")
    zero = F.lit(0).cast("decimal(38,2)")
    # One row per month: the un-partitioned window only ever sees a few hundred rows.
    by_month = Window.orderBy("report_month", "year", "month")
    return k.select(
        "report_month", "year", "month", "total_active_accounts", "active_accounts", "high_activity_accounts",
        F.when(accounts > 0, div_half_up(active, accounts, 2, times=100)).otherwise(zero).alias(
            "account_activation_rate_pct"
        ),
        "total_inbound_volume", "total_outbound_volume", "total_net_flow",
        F.when(outbound > 0, div_half_up(inbound, outbound, 2, num_scale=2, den_scale=2)).alias("inflow_outflow_ratio"),
        "total_transactions", "total_pix_transactions", "total_transfer_transactions",
        F.when(tx > 0, div_half_up(pix_tx, tx, 2, times=100)).otherwise(zero).alias("pix_adoption_rate_pct"),
        _avg_of_avgs(F.col("avg_in_sum"), F.col("avg_in_n")).alias("avg_inbound_amount"),
        _avg_of_avgs(F.col("avg_out_sum"), F.col("avg_out_n")).alias("avg_outbound_amount"),
        "total_pix_flow", "total_transfer_flow",
        F.when(
            (pix_flow + transfer_flow) != 0,
            div_half_up(pix_flow, pix_flow + transfer_flow, 2, num_scale=2, den_scale=2, times=100),
        ).otherwise(zero).alias("pix_volume_share_pct"),
        F.lag("total_inbound_volume").over(by_month).alias("prev_month_inbound_volume"),
        F.lag("total_transactions").over(by_month).alias("prev_month_transactions"),
    )


def kpi_month_over_month(kpi: DataFrame) -> DataFrame:
    return kpi.select(
        "report_month", "total_inbound_volume", "prev_month_inbound_volume",
        "total_transactions", "prev_month_transactions",
    )


# -- report_customer_segmentation ------------------------------------------------

SEGMENT_KEYS = ["customer_segment", "geographic_segment", "profile_completeness_segment", "name_length_category", "city_tier"]


def segment_customers(dim_cust: DataFrame, tier1_cities: list[str] = L.TIER1_CITIES) -> DataFrame:
    country = F.col("country_normalized")
    domestic = country.isin(L.DOMESTIC_COUNTRIES)
    name, city, cpf = F.col("has_complete_name"), F.col("has_city_info"), F.col("has_valid_cpf")
    city_text = F.upper(F.col("customer_city").cast("string"))
    return dim_cust.select(
        "*",
        F.when(domestic, "Domestic").when(country.isNotNull(), "International").otherwise("Unknown Location").alias(
            "geographic_segment"
        ),
        F.when(name & city & cpf, "Complete Profile")
        .when(name & cpf, "Partial Profile - Missing Location")
        .when(cpf, "Minimal Profile - CPF Only")
        .otherwise("Incomplete Profile")
        .alias("profile_completeness_segment"),
        F.when(name & city & cpf & domestic, "Premium Domestic")
        .when(name & city & cpf, "Premium International")
        .when(name & cpf, "Standard Customer")
        .when(cpf, "Basic Customer")
        .otherwise("Incomplete Customer")
        .alias("customer_segment"),
        F.when(city_text.isin(tier1_cities), "Tier 1 City")
        .when(F.col("customer_city").isNotNull(), "Other City")
        .otherwise("Unknown City")
        .alias("city_tier"),
    )


def report_customer_segmentation(dim_cust: DataFrame, tier1_cities: list[str] = L.TIER1_CITIES) -> DataFrame:
    """Counts and rates per segment combination, ordered by size.

    The grouped frame has at most 5*3*4*3*3 = 540 rows (one per label
    combination), so the grand-total window over it is a tiny single task.
    """
    s = segment_customers(dim_cust, tier1_cities)
    g = s.groupBy(*SEGMENT_KEYS).agg(
        F.count(F.lit(1)).alias("customers_count"),
        F.count_if("has_complete_name").alias("customers_with_complete_name"),
        F.count_if("has_city_info").alias("customers_with_city"),
        F.count_if("has_valid_cpf").alias("customers_with_valid_cpf"),
        F.count_if(F.col("geographic_segment") == "Domestic").alias("domestic_customers"),
        F.count_if(F.col("geographic_segment") == "International").alias("international_customers"),
        F.count_if(F.col("profile_completeness_segment") == "Complete Profile").alias("complete_profile_customers"),
        F.count_if(F.col("profile_completeness_segment").like("%Partial%")).alias("partial_profile_customers"),
        F.count_if(F.col("name_length_category") == "Long Name").alias("long_name_customers"),
        F.count_if(F.col("name_length_category") == "Medium Name").alias("medium_name_customers"),
        F.count_if(F.col("name_length_category") == "Short Name").alias("short_name_customers"),
    )
    n = F.col("customers_count")
    grand = F.sum("customers_count").over(Window.partitionBy())
    return g.select(
        *g.columns,
        div_half_up(n, grand, 2, times=100).alias("segment_percentage"),
        div_half_up(F.col("customers_with_valid_cpf"), n, 2, times=100).alias("cpf_completion_rate"),
        div_half_up(F.col("customers_with_complete_name"), n, 2, times=100).alias("name_completion_rate"),
        div_half_up(F.col("customers_with_city"), n, 2, times=100).alias("city_completion_rate"),
    ).orderBy(F.col("customers_count").desc(), *SEGMENT_KEYS)
