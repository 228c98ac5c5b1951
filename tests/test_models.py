"""Branch and edge tests of the models on hand-made frames (values the adapter never reaches)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.plans import intermediate as I
from ledgerline.plans import marts as M
from ledgerline.plans import staging as S

TS = dt.datetime


def _unified(spark, rows):
    schema = (
        "transaction_id long, account_id long, transaction_amount decimal(18,2), transaction_requested_at timestamp_ntz, "
        "transaction_completed_at timestamp_ntz, transaction_status string, transaction_direction string, "
        "transaction_channel string, transaction_type string, source_table string"
    )
    return spark.createDataFrame(rows, schema)


def _calendar(spark, days, extra_same_day=()):
    rows = [(i + 1, f"{d} 00:00:00", 1, d.month, d.year, d.isoweekday()) for i, d in enumerate(days)]
    rows += [(1000 + i, f"{d} 12:00:00", 1, d.month, d.year, d.isoweekday()) for i, d in enumerate(extra_same_day)]
    d_time = spark.createDataFrame(rows, "time_id long, action_timestamp string, week_id int, month_id int, year_id int, weekday_id int")
    d_week = spark.createDataFrame([(w, w) for w in range(1, 54)], "week_id int, action_week int")
    d_month = spark.createDataFrame([(m, m) for m in range(1, 13)], "month_id int, action_month long")
    d_year = spark.createDataFrame([(y, y) for y in range(1990, 2030)], "year_id int, action_year int")
    names = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    d_weekday = spark.createDataFrame(list(enumerate(names, start=1)), "weekday_id int, action_weekday string")
    return S.base_time_dimension(d_time, d_week, d_month, d_year, d_weekday)


def test_size_classes_at_boundaries(spark):
    amounts = ["99.99", "100", "999.99", "1000", "9999.99", "10000", "99999.99", "100000"]
    rows = [(i, 1, Decimal(a), None, TS(2020, 1, 2), "completed", "in", "PIX", "PIX_IN", "pix_movements") for i, a in enumerate(amounts)]
    cal = _calendar(spark, [dt.date(2020, 1, 2)])
    got = {r.transaction_amount: (r.transaction_size_category, r.is_large_transaction)
           for r in I.int_transactions_enriched(_unified(spark, rows), cal).collect()}
    assert [got[Decimal(a)][0] for a in amounts] == ["micro", "small", "small", "medium", "medium", "large", "large", "enterprise"]
    assert got[Decimal("999.99")][1] is False and got[Decimal("1000")][1] is True


def test_calendar_fan_out_and_gap(spark):
    # two timestamps on 2020-01-02 repeat the transaction; 2020-02-10 is missing from the calendar
    days = [dt.date(2020, 1, 1), dt.date(2020, 1, 2), dt.date(2020, 2, 1)]
    cal = _calendar(spark, days, extra_same_day=[dt.date(2020, 1, 2)])
    rows = [
        (1, 7, Decimal("10.00"), None, TS(2020, 1, 2, 9), "completed", "in", "PIX", "PIX_IN", "pix_movements"),
        (2, 7, Decimal("5.00"), None, TS(2020, 2, 10, 9), "completed", "out", "TRANSFER", "TRANSFER_OUT", "transfer_outs"),
    ]
    enriched = I.int_transactions_enriched(_unified(spark, rows), cal)
    assert enriched.where("transaction_id = 1").count() == 2
    gap = enriched.where("transaction_id = 2").first()
    assert gap.completed_date is None and gap.completed_month_date is None

    spine = spark.createDataFrame(
        [(7, 2020, 1, dt.date(2020, 1, 1)), (7, 2020, 2, dt.date(2020, 2, 1))], "account_id long, year int, month long, month_date date"
    )
    by_trunc = {r.month_date: r for r in I.int_monthly_transaction_summary(spine, enriched).collect()}
    by_cal = {r.month_date: r for r in I.int_transactions_summary(spine, enriched).collect()}
    # truncated completion month keeps the February transfer; the calendar month loses it
    assert by_trunc[dt.date(2020, 2, 1)].total_transactions == 1
    assert by_trunc[dt.date(2020, 2, 1)].outbound_volume == Decimal("5.00")
    assert by_cal[dt.date(2020, 2, 1)].total_transactions == 0
    assert by_cal[dt.date(2020, 2, 1)].avg_outbound_amount is None
    assert by_trunc[dt.date(2020, 1, 1)].total_transactions == 2  # fan-out counted twice


def test_spine_ranges_and_defaults(spark):
    cal = _calendar(spark, [dt.date(2020, m, 1) for m in range(1, 13)])
    accounts = spark.createDataFrame(
        [(1, "a", TS(2019, 1, 1), "active", "accounts"), (2, "b", TS(2019, 1, 1), "active", "accounts"),
         (3, "c", TS(2019, 1, 1), "inactive", "accounts")],
        "account_id long, account_name string, account_created_at timestamp_ntz, account_status string, source_table string",
    )
    stg = spark.createDataFrame(
        [(1, TS(2020, 3, 15), "completed"), (1, TS(2020, 5, 2), "completed"), (1, None, "completed")],
        "account_id long, transaction_completed_at timestamp_ntz, transaction_status string",
    )
    spine = I.int_account_monthly_spine(accounts, cal, stg, as_of=dt.date(2020, 10, 15), default_start=dt.date(2020, 8, 1))
    got = sorted((r.account_id, r.month) for r in spine.collect())
    assert got == [(1, 3), (1, 4), (1, 5), (2, 8), (2, 9), (2, 10)]


def test_dim_account_bands(spark):
    as_of = dt.date(2021, 1, 1)
    ages = [29, 30, 31, 89, 90, 364, 365]
    accounts = spark.createDataFrame(
        [(i, f"a{i}", TS.combine(as_of - dt.timedelta(days=a), dt.time()), "active" if i % 2 else "inactive", "accounts")
         for i, a in enumerate(ages)],
        "account_id long, account_name string, account_created_at timestamp_ntz, account_status string, source_table string",
    )
    enriched = spark.createDataFrame(
        [(0, Decimal("999.99"), TS(2020, 12, 15)), (1, Decimal("1000.00"), TS(2020, 11, 1))],
        "account_id long, transaction_amount decimal(18,2), transaction_completed_at timestamp_ntz",
    )
    got = {r.account_id: r for r in M.dim_account(accounts, enriched, as_of).collect()}
    assert [got[i].account_age_segment for i in range(7)] == [
        "New (< 30 days)", "Recent (30-90 days)", "Recent (30-90 days)", "Recent (30-90 days)",
        "Established (3-12 months)", "Established (3-12 months)", "Mature (> 1 year)",
    ]
    assert [got[i].is_new_account for i in range(3)] == [True, True, False]
    assert got[0].value_tier == "Low Value" and got[1].value_tier == "Medium Value" and got[2].value_tier == "No Value"
    assert got[0].activity_segment == "Low Activity" and got[2].activity_segment == "Inactive"
    assert got[0].is_recently_active is True and got[1].is_recently_active is False
    assert got[2].has_transactions is False and got[2].total_lifetime_transactions == 0
    assert got[1].is_active is True and got[0].is_active is False


def test_balances_levels_and_ratio(spark):
    rows = [(1, 2020, 1, Decimal(i), Decimal(o), Decimal(0), t, 0, 0, Decimal(0), Decimal(0), p, x, None, None, dt.date(2020, 1, 1), t > 0)
            for i, o, t, p, x in [(10, 0, 0, 0, 0), (10, 3, 5, 3, 2), (1, 3, 6, 3, 3), (5, 5, 20, 0, 20), (7, 2, 21, 11, 10)]]
    schema = (
        "account_id long, year int, month long, inbound_volume decimal(28,2), outbound_volume decimal(28,2), net_flow decimal(28,2), "
        "total_transactions long, inbound_transactions long, outbound_transactions long, pix_net_flow decimal(28,2), "
        "transfer_net_flow decimal(28,2), pix_transactions long, transfer_transactions long, "
        "avg_inbound_transaction_amount decimal(22,6), avg_outbound_transaction_amount decimal(22,6), month_date date, has_activity boolean"
    )
    got = M.fct_account_monthly_balances(spark.createDataFrame(rows, schema)).collect()
    assert [r.activity_level for r in got] == ["No Activity", "Low Activity", "Medium Activity", "Medium Activity", "High Activity"]
    assert [r.channel_preference for r in got] == ["No Activity", "PIX Preferred", "Mixed Usage", "Transfer Preferred", "PIX Preferred"]
    assert [r.inbound_outbound_ratio for r in got] == [None, Decimal("3.33"), Decimal("0.33"), Decimal("1.00"), Decimal("3.50")]
    assert [r.is_high_activity for r in got] == [False, False, False, True, True]


def test_kpi_zero_outbound_and_opposite_flows(spark):
    schema = (
        "account_id long, year int, month long, inbound_volume decimal(28,2), outbound_volume decimal(28,2), net_flow decimal(28,2), "
        "total_transactions long, pix_transactions long, transfer_transactions long, pix_net_flow decimal(28,2), "
        "transfer_net_flow decimal(28,2), avg_inbound_transaction_amount decimal(22,6), avg_outbound_transaction_amount decimal(22,6), "
        "month_date date, has_activity boolean, is_high_activity boolean"
    )
    m1, m2 = dt.date(2020, 1, 1), dt.date(2020, 2, 1)
    rows = [
        (1, 2020, 1, Decimal(5), Decimal(0), Decimal(5), 1, 1, 0, Decimal(5), Decimal(-5), Decimal("1.000005"), None, m1, True, False),
        (2, 2020, 1, Decimal(0), Decimal(0), Decimal(0), 0, 0, 0, Decimal(0), Decimal(0), Decimal("2.000000"), None, m1, False, False),
        (1, 2020, 2, Decimal(0), Decimal(0), Decimal(0), 0, 0, 0, Decimal(0), Decimal(0), None, None, m2, False, False),
    ]
    got = {r.report_month: r for r in M.report_monthly_business_kpi(spark.createDataFrame(rows, schema)).collect()}
    jan, feb = got[m1], got[m2]
    assert jan.inflow_outflow_ratio is None
    assert jan.pix_volume_share_pct == Decimal("0.00")  # flows cancel: guarded
    assert jan.account_activation_rate_pct == Decimal("50.00")
    assert jan.avg_inbound_amount == Decimal("1.50")  # avg(1.000005, 2) = 1.5000025 -> 1.50
    assert feb.prev_month_inbound_volume == Decimal("5.00") and feb.prev_month_transactions == 1
    assert feb.avg_inbound_amount is None and feb.pix_adoption_rate_pct == Decimal("0.00")


def test_segmentation_labels(spark):
    rows = [
        (1, 12345678901, "Ana", "Silva", "SAO PAULO", "Brazil"),     # string city in the tier-1 list
        (2, 12345678902, "Bo", "Li", "Lima", "Peru"),
        (3, 12345678903, "Cy", "Ng", None, "Brasil"),
        (4, 123456789, "Di", "Ko", "X", None),
        (5, 12345678905, None, "Solo", None, None),
        (6, None, "Ed", "Oz", None, "Chile"),
    ]
    cust = spark.createDataFrame(rows, "customer_id long, cpf long, first_name string, last_name string, customer_city string, country_name string")
    dim = M.dim_customer(cust.withColumn("source_table", F.lit("customers")))
    seg = {r.customer_id: r for r in M.segment_customers(dim).collect()}
    assert seg[1].city_tier == "Tier 1 City" and seg[1].customer_segment == "Premium Domestic"
    assert seg[2].customer_segment == "Premium International" and seg[2].geographic_segment == "International"
    assert seg[3].profile_completeness_segment == "Partial Profile - Missing Location" and seg[3].customer_segment == "Standard Customer"
    assert seg[4].customer_segment == "Incomplete Customer" and seg[4].geographic_segment == "Unknown Location"
    assert seg[5].profile_completeness_segment == "Minimal Profile - CPF Only" and seg[5].customer_segment == "Basic Customer"
    assert seg[6].city_tier == "Unknown City" and seg[6].name_length_category == "Short Name"
    rep = M.report_customer_segmentation(dim).collect()
    assert sum(r.segment_percentage for r in rep) == Decimal("100.02") or abs(sum(r.segment_percentage for r in rep) - 100) < 1
    assert sum(r.customers_count for r in rep) == 6


def test_location_hierarchy_nulls(spark):
    city = spark.createDataFrame([("Recife", 1, 10), ("Nowhere", 99, 11)], "city_name string, state_id long, city_id long")
    state = spark.createDataFrame([("Pernambuco", 1, 1)], "state string, country_id int, state_id int")
    country = spark.createDataFrame([("Brazil", 1)], "country string, country_id long")
    got = {r.location_id: r for r in S.base_location_hierarchy(city, state, country).collect()}
    assert got[10].full_location_path == "Brazil > Pernambuco > Recife" and got[10].country_iso2 == "BR"
    assert got[11].full_location_path is None and got[11].country_iso2 is None


def test_calendar_attributes(spark):
    days = [dt.date(2020, 2, 29), dt.date(2020, 3, 1), dt.date(2020, 12, 31), dt.date(2021, 1, 4)]
    cal = {r.utc_date: r for r in _calendar(spark, days).collect()}
    leap = cal[dt.date(2020, 2, 29)]
    assert leap.is_month_end and not leap.is_month_start and leap.business_day_type == "weekend" and leap.is_summer_brazil
    assert cal[dt.date(2020, 3, 1)].is_month_start
    assert cal[dt.date(2020, 12, 31)].week_of_year == 53 and cal[dt.date(2020, 12, 31)].business_day_type == "weekday"
    monday = cal[dt.date(2021, 1, 4)]
    assert monday.business_day_type == "week_start" and monday.week_start_date == dt.date(2021, 1, 4)
    assert monday.year_month == "2021-01" and monday.year_quarter == "2021-Q1" and monday.quarter_name == "Q1"
