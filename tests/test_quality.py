import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import quality as Q


def test_row_count_limits(spark):
    df = spark.range(10)
    assert Q.row_count_check(df, "m", above=10).first().error_type is None          # equality passes
    assert Q.row_count_check(df, "m", above=11).first().error_type == "TOO_FEW_ROWS"
    assert Q.row_count_check(df, "m", above=0, below=10).first().error_type is None
    assert Q.row_count_check(df, "m", above=0, below=9).first().error_type == "TOO_MANY_ROWS"
    assert Q.row_count_failures(df, "m", above=10).count() == 0


def test_accepted_range_severity(spark):
    def status(bad):
        df = spark.range(100).select(F.when(F.col("id") < bad, F.lit(0.0)).otherwise(F.lit(5.0)).alias("amount"))
        return Q.accepted_range_summary(df, "m", "amount").first().status

    assert [status(n) for n in (0, 1, 50, 51)] == ["pass", "warn", "warn", "error"]


def test_unique_not_null_and_values(spark):
    df = spark.createDataFrame([(1, "in"), (1, "out"), (2, "sideways"), (None, None), (None, "in")], "k long, d string")
    assert Q.unique_summary(df, "m", "k").first().failures == 1          # NULL keys are not duplicates
    assert Q.not_null_summary(df, "m", "k").first().failures == 2
    bad = Q.accepted_values_failures(df, "m", "d", ["in", "out"]).collect()
    assert [(r.value, r.n_records) for r in bad] == [("sideways", 1)]     # NULL is not tested


def test_relationships_and_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,), (9,)], "account_id long")
    parent = spark.createDataFrame([(1,), (3,)], "account_id long")
    r = Q.relationship_summary(child, "account_id", parent, "account_id", "c", "p").first()
    assert (r.failing_rows, r.failing_keys) == (3, 2)
    orphans = {row.account_id: row.orphaned_transactions for row in Q.orphan_transactions(child, parent).collect()}
    assert orphans == {2: 2, 9: 1, None: 1}


def test_duplicates_and_missing_dates(spark):
    u = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "transaction_id long")
    got = {r.transaction_id: r.occurrence_count for r in Q.duplicate_transactions(u).collect()}
    assert got == {1: 2, None: 2}
    cal = spark.createDataFrame([(dt.date(2020, 1, 1),), (dt.date(2020, 1, 3),)], "utc_date date")
    spine = Q.date_spine(F.lit(dt.date(2020, 1, 1)), F.lit(dt.date(2020, 1, 5)), spark.range(1))
    missing = [r.expected_date for r in Q.missing_dates(spine, cal, dt.date(2020, 1, 4)).orderBy("expected_date").collect()]
    assert missing == [dt.date(2020, 1, 2), dt.date(2020, 1, 4)]


def test_freshness_boundary_and_summary(spark):
    now = dt.datetime(2024, 1, 1, 12, 0, 0)
    log = spark.createDataFrame(
        [("pix_movements", now - dt.timedelta(hours=4)),            # exactly at the limit: stale (must be newer)
         ("transfer_ins", now - dt.timedelta(hours=3, minutes=59)),
         ("accounts", now - dt.timedelta(hours=23))],
        "table_name string, seen_at timestamp_ntz",
    )
    cats = Q.table_categories(spark)
    fresh = {r.table_name: r for r in Q.freshness(log, cats, as_of=F.lit(now).cast("timestamp_ntz")).collect()}
    assert fresh["pix_movements"].severity == "critical"
    assert fresh["transfer_ins"].is_fresh is True
    assert fresh["transfer_outs"].severity == "critical"              # never seen
    assert fresh["accounts"].is_fresh is True and fresh["customers"].severity == "warning"
    counts = spark.createDataFrame([("city", 3), ("d_time", 0)], "table_name string, record_count long")
    lookups = Q.non_empty(counts, cats)
    summary = {r.category: r for r in Q.validation_summary(Q.freshness(log, cats, as_of=F.lit(now).cast("timestamp_ntz")), lookups).collect()}
    assert summary["high_frequency"].missing_tables == "pix_movements,transfer_outs"
    assert summary["high_frequency"].severity == "critical" and summary["low_frequency"].severity == "warning"
    assert all(r.pipeline_fails for r in summary.values())
    assert summary["low_frequency"].missing_count == 7
