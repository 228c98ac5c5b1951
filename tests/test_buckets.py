"""Tables bucketed by account: no exchange of facts, hot accounts apart, other sessions, edges."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import marts as M
from ledgerline.plans.bucketed import BucketedModels
from ledgerline.plans.catalog import QUERIES, models
from ledgerline.sources import buckets as B
from tests.compare import rows_digest
from tests.test_plans import large_tables  # noqa: F401

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def digest(df):
    cols = sorted(df.columns)
    return rows_digest(cols, [tuple(r[c] for c in cols) for r in df.collect()])


@pytest.fixture(scope="module")
def tables(spark):
    return BucketedModels.write(models(spark, SF), tempfile.mkdtemp(prefix="ll-buckets-") + "/t", buckets=4)


@pytest.mark.parametrize(("model", "query"), [("dim_account", None), ("int_monthly_transaction_summary", None), ("orphan_transactions", "dq_orphan_transactions")])
def test_models_without_an_exchange_of_facts(large_tables, tables, model, query):  # noqa: F811
    made = getattr(tables, model)()
    plan = made._jdf.queryExecution().executedPlan().toString()
    # the union's first branch is the bucketed part: up to the second branch, which starts at the same depth
    lines = plan.splitlines()
    top = next(i for i, line in enumerate(lines) if "Union" in line)
    depth = lines[top + 1].index(":-")
    second = next(i for i in range(top + 2, len(lines)) if lines[i][depth : depth + 2] == "+-")
    first = "\n".join(lines[top:second])
    assert "Bucketed: true" in first and "Exchange hashpartitioning(account_id" not in first
    assert digest(made) == digest(QUERIES[query or model](large_tables, SF))


def test_hot_accounts_are_apart(spark):
    """One account with a third of all rows: its rows leave the buckets, no bucket is twice the median, results stay."""
    facts = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.when(F.col("id") % 101 == 0, None).otherwise(F.col("id") % 2000)).cast("long").alias("account_id"),
        (F.lit("2020-01-01").cast("timestamp_ntz") + F.expr("INTERVAL '1' HOUR") * (F.col("id") % 5000)).alias("transaction_completed_at"),
        F.lit(1).cast("decimal(18,2)").alias("transaction_amount"),
    )
    root = tempfile.mkdtemp(prefix="ll-hot-")
    t = B.write_bucketed(facts, f"{root}/facts", "account_id", 8)
    assert [r.account_id for r in t.hot_keys.collect()] == [7] and t.hot.count() == facts.where("account_id = 7").count() > 10_000
    assert t.cold.where("account_id = 7").count() == 0 and t.all().count() == 30_000
    sizes = [r["count"] for r in t.cold.groupBy(F.pmod(F.hash("account_id"), F.lit(8))).count().collect()]
    assert max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]
    cold, hot = M.account_activity(t.cold), M.account_activity(t.hot)
    assert "Exchange" not in cold._jdf.queryExecution().executedPlan().toString()
    assert digest(cold.unionByName(hot)) == digest(M.account_activity(facts))


def test_hot_keys_are_not_searched_in_one_task(spark):
    """Only the found keys meet in one partition: the counts are filtered where they are (the key counts once ran in the
    task that writes the keys)."""
    root = tempfile.mkdtemp(prefix="ll-hotkeys-")
    facts = spark.range(0, 9000, 1, 6).selectExpr("if(id % 3 = 0, 7, id) AS k")
    t = B.write_bucketed(facts, f"{root}/t", "k", 4)
    counts = spark.read.parquet(f"{root}/t/key_counts")
    assert counts.count() == 6000
    found = B.hot_keys(counts, "k", 4, 9000)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan and "Aggregate" not in plan and plan.index("Exchange SinglePartition") < plan.index("Filter")
    assert [r.k for r in found.collect()] == [r.k for r in t.hot_keys.collect()] == [7]


def test_buckets_follow_the_rows(spark, monkeypatch):
    """Four times the rows: four times the buckets, none fuller; exact where the number is given."""
    monkeypatch.setattr(B, "ROWS_PER_BUCKET", 500)
    root = tempfile.mkdtemp(prefix="ll-grow-")
    fullest = []
    for rows, buckets in ((1500, 4), (4000, 8), (16_000, 32)):
        df = spark.range(rows).selectExpr("id AS k")
        t = B.write_bucketed(df, f"{root}/g{rows}", "k", 4, grow=True)
        assert t.buckets == buckets and t.all().count() == rows
        fullest.append(max(r["count"] for r in t.cold.groupBy(F.pmod(F.hash("k"), F.lit(buckets))).count().collect()))
        assert B.write_bucketed(df, f"{root}/f{rows}", "k", 4).buckets == 4
    assert max(fullest) < 2 * 500
    assert B.write_bucketed(spark.range(0).selectExpr("id AS k"), f"{root}/e", "k", 4, grow=True).buckets == 4


@pytest.mark.parametrize(("model", "query"), [("dim_account", None), ("int_monthly_transaction_summary", None), ("orphan_transactions", "dq_orphan_transactions")])
def test_models_over_more_buckets(spark, monkeypatch, model, query):
    monkeypatch.setattr(B, "ROWS_PER_BUCKET", 300)
    t = BucketedModels.write(models(spark, SF), tempfile.mkdtemp(prefix="ll-more-") + "/t", buckets=2)
    assert t.unified.buckets == t.enriched.buckets == t.accounts.buckets == B.buckets_for(t.unified.all().count(), 2) > 2
    assert digest(getattr(t, model)()) == digest(QUERIES[query or model](spark, SF))


def test_another_session_attaches_the_folder(spark):
    root = tempfile.mkdtemp(prefix="ll-attach-")
    made = B.write_bucketed(spark.range(100).selectExpr("id % 10 AS k", "cast(id AS string) AS v"), f"{root}/t", "k", 4)
    want = sorted(map(tuple, made.all().collect()))
    B.drop(spark, made, f"{root}/t")
    again = B.attach(spark, f"{root}/t")
    assert sorted(map(tuple, again.all().collect())) == want
    plan = again.cold.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan


def test_empty_tables_and_null_keys(spark):
    root = tempfile.mkdtemp(prefix="ll-bedge-")
    empty = B.write_bucketed(spark.range(0).selectExpr("id AS k"), f"{root}/e", "k", 4)
    assert empty.all().count() == 0
    nulls = B.write_bucketed(spark.range(100).selectExpr("nullif(id % 2, 1) AS k", "id"), f"{root}/n", "k", 4)
    assert nulls.all().count() == 100 and {r.k for r in nulls.hot_keys.collect()} == {0, None}


def test_distinct_accounts_of_repeating_balances(spark):
    """Repeated accounts, null accounts and flags, ids around a bitmap's border and below zero."""
    rows = []
    for month in (1, 2):
        for a in (1, 2, 2, 32767, 32768, 32769, 10**12, -1, -40000, None):
            rows.append((a, f"2020-0{month}-01", 2020, month, (a or 0) % 2 == 0, None if a == 2 else (a or 0) % 3 == 0))
    rows += [(None, "2020-03-01", 2020, 3, True, True), (5, None, None, None, True, True)]
    df = spark.createDataFrame(rows, "account_id long, d string, year int, month int, has_activity boolean, is_high_activity boolean")
    df = df.withColumn("month_date", F.col("d").cast("date")).repartition(5)
    got = {r.month: tuple(r)[3:] for r in M.monthly_distinct_accounts(df).collect()}
    want = {}
    for month in (1, 2, 3):
        own = [r for r in rows if r[3] == month and r[0] is not None]
        want[month] = (len({r[0] for r in own}), len({r[0] for r in own if r[4]}), len({r[0] for r in own if r[5]}))
    assert got == want
