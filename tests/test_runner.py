import os
import tempfile

import pytest
from pyspark.sql import Window

from ledgerline.plans import runner
from ledgerline.plans.catalog import QUERIES
from ledgerline.sources.adapter import RawTables
from ledgerline.sources.sink import materialize, read_table
from ledgerline.sources.versions import ConcurrentPublish, VersionedTables
from tests.compare import rows_digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def test_run_writes_every_model_equal_to_lazy_queries(spark):
    out = tempfile.mkdtemp(prefix="ll-run-")
    result = runner.run(spark, RawTables(spark, SF), out)
    assert set(result.tables) == set(runner.LAYOUT)
    for name in ["report_monthly_business_kpi", "fct_account_monthly_balances", "dim_account", "int_transactions_summary"]:
        written = read_table(spark, result.tables[name])
        lazy = QUERIES[name](spark, SF)
        cols = lazy.columns
        assert set(cols) <= set(written.columns)
        assert {c for c in written.columns if c.startswith("_")} == {c for c, has in (("_loaded_at", runner.LOADED), ("_processed_at", runner.PROCESSED)) if name in has}
        assert rows_digest(cols, [tuple(r) for r in written.select(*cols).collect()]) == rows_digest(cols, [tuple(r) for r in lazy.collect()]), name
    failures = {r["check"]: r["failures"] for r in runner.failing_checks(result).collect()}
    assert failures["missing_dates"] > 0 and failures["duplicate_transactions"] > 0 and failures["calendar_unique_per_date"] > 0


def test_transfers_keep_every_line(spark):
    raw = RawTables(spark, SF)
    n = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert raw["transfer_ins"].count() + raw["transfer_outs"].count() == n == raw.transfers.count()


def test_each_model_is_built_once_and_read_back(spark, monkeypatch):
    """A consumer's plan reads the written tables, never the driver's facts again."""
    plans = {}
    real = VersionedTables.stage

    def spy(self, df, table, **kw):
        plans[table] = df._jdf.queryExecution().optimizedPlan().toString()
        return real(self, df, table, **kw)

    monkeypatch.setattr(VersionedTables, "stage", spy)
    runner.run(spark, RawTables(spark, SF), tempfile.mkdtemp(prefix="ll-once-"))
    assert set(plans) == set(runner.LAYOUT)
    facts = [name for name, plan in plans.items() if "l_orderkey" in plan]
    assert facts == ["int_unified_transactions"]


def test_failed_write_keeps_the_old_table(spark):
    from pyspark.sql import functions as F

    path = tempfile.mkdtemp(prefix="ll-keep-") + "/t"
    assert materialize(spark.range(5).toDF("k"), path, cluster_by=["k"]).count() == 5
    before = read_table(spark, path)
    bad = spark.range(5).select(F.raise_error(F.lit("broken")).cast("long").alias("k"))
    with pytest.raises(Exception):
        materialize(bad, path)
    assert read_table(spark, path).count() == 5 and len(os.listdir(f"{os.path.dirname(path)}/data/t")) == 1
    assert materialize(spark.range(7).toDF("k"), path).count() == 7
    assert before.count() == 5 and read_table(spark, path, run=1).count() == 5  # readers of the old version go on
    assert materialize(spark.range(9).toDF("k"), path).count() == 9
    assert len(os.listdir(f"{os.path.dirname(path)}/data/t")) == 2  # the last two runs' versions


def test_publish_switches_all_tables_at_once(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="ll-versions-")
    w = VersionedTables(spark, root)
    with pytest.raises(FileNotFoundError):
        w.read("a")
    with pytest.raises(ValueError):
        w.publish()
    for t in "ab":
        w.stage(spark.range(3), t)
    with pytest.raises(FileNotFoundError):
        VersionedTables(spark, root).read("a")  # staged is not published
    assert w.read_staged("a").count() == 3 and w.publish("first") == 1
    w.stage(spark.range(4), "a")

    # a reader at every moment of the second publish: the old tables until the log file is there
    seen = []
    real = VersionedTables._append

    def watched(self, versions, note):
        other = VersionedTables(spark, root)
        seen.append([other.read(t).count() for t in "ab"])
        run = real(self, versions, note)
        seen.append([other.read(t).count() for t in "ab"])
        return run

    monkeypatch.setattr(VersionedTables, "_append", watched)
    w.stage(spark.range(5), "b")
    assert w.publish() == 2 and seen == [[3, 3], [4, 5]]

    # a failure before the log file appears loses and switches nothing
    def fails(self, versions, note):
        raise OSError("store is away")

    monkeypatch.setattr(VersionedTables, "_append", fails)
    w.stage(spark.range(6), "a")
    with pytest.raises(OSError):
        w.publish()
    monkeypatch.setattr(VersionedTables, "_append", real)
    other = VersionedTables(spark, root)
    assert [other.read(t).count() for t in "ab"] == [4, 5]
    assert w.publish() == 3 and other.read("a").count() == 6  # still staged: the publish can be repeated

    assert w.rollback(1) == 4 and [other.read(t).count() for t in "ab"] == [3, 3]
    assert w.rollback(3, ["a"]) == 5 and [other.read(t).count() for t in "ab"] == [6, 3]
    assert other.read("a", run=2).count() == 4
    gone = w.vacuum(keep_runs=1)
    assert len(gone) == 3 and [other.read(t).count() for t in "ab"] == [6, 3]
    assert w.vacuum(keep_runs=1) == []
    assert [(r.run, r.table_name) for r in w.history().orderBy("run", "table_name").collect()] == [(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "a"), (4, "a"), (4, "b"), (5, "a")]
    w.stage(spark.range(1), "a")
    w.discard()
    assert w.staged == {} and len(os.listdir(f"{root}/data/a")) == 1


def test_two_writers_are_told_apart(spark, monkeypatch):
    """Both publish run 1: one counts for every reader, the other is told."""
    root = tempfile.mkdtemp(prefix="ll-rivals-")
    a, b = VersionedTables(spark, root), VersionedTables(spark, root)
    a.stage(spark.range(1), "t")
    b.stage(spark.range(2), "t")
    real, first = VersionedTables.history, []

    def late(self):
        """b reads the history before a has published."""
        if self is b and not first:
            rows = real(self)
            first.append(1)
            a.publish()
            return rows
        return real(self)

    monkeypatch.setattr(VersionedTables, "history", late)
    try:
        b.publish()
        told = False
    except ConcurrentPublish:
        told = True
    assert sorted(r.run for r in real(a).collect()) == [1, 1]
    assert VersionedTables(spark, root).read("t").count() == (1 if told else 2)


@pytest.mark.parametrize(("bad", "raises"), [(50, False), (51, True)])
def test_error_severity_raises(spark, bad, raises):
    from pyspark.sql import functions as F

    class Raw(RawTables):
        def _build_pix_movements(self):
            amount = F.when(F.row_number().over(Window.orderBy("id")) <= bad, F.lit(0)).otherwise(F.lit(5)).cast("decimal(18,2)")
            return super()._build_pix_movements().withColumn("status", F.lit("completed")).withColumn("pix_amount", amount)

        @property
        def transfers(self):
            return super().transfers.withColumn("amount", F.lit(5).cast("decimal(18,2)"))

    out = tempfile.mkdtemp(prefix="ll-sev-")
    if raises:
        with pytest.raises(RuntimeError, match="severity error"):
            runner.run(spark, Raw(spark, SF), out, fail_on_error=["accepted_range"])
        assert os.listdir(out) == []  # stopped before the first model
    else:
        result = runner.run(spark, Raw(spark, SF), out, fail_on_error=["accepted_range"])
        assert {r.severity for r in runner.failing_checks(result).where("check = 'accepted_range'").collect()} == {"warn"}


def test_a_failing_layer_publishes_nothing(spark):
    """The test data repeats transaction ids: that test guards the marts, and the tables of the last run stay."""
    out = tempfile.mkdtemp(prefix="ll-gate-")
    before = runner.run(spark, RawTables(spark, SF), out, as_of=runner.AS_OF)
    rows = read_table(spark, before.tables["dim_account"]).count()
    with pytest.raises(RuntimeError, match="duplicate_transactions"):
        runner.run(spark, RawTables(spark, SF), out, fail_on_error=["duplicate_transactions"])
    tables = VersionedTables(spark, out)
    assert tables.history().agg({"run": "max"}).first()[0] == before.run == 1
    assert read_table(spark, before.tables["dim_account"]).count() == rows
    assert {len(os.listdir(f"{out}/data/{t}")) for t in runner.ORDER} == {1}  # what was staged is gone
    with pytest.raises(RuntimeError, match="not_null|unique"):
        runner.run(spark, RawTables(spark, SF), tempfile.mkdtemp(prefix="ll-gate2-"), fail_on_error=True)


def test_layout_of_written_files(spark):
    """Files hold ranges of the cluster key in order; point-lookup columns get bloom filters; more rows, more files."""
    import pyarrow.parquet as pq

    out = tempfile.mkdtemp(prefix="ll-layout-")

    def files(table):
        path = VersionedTables(spark, out).resolve(table)
        return [f"{path}/{f}" for f in sorted(os.listdir(path)) if f.endswith(".parquet")]

    assert "account_id" in runner.LAYOUT["fct_transactions"][1] and "transaction_type" in runner.LAYOUT["int_unified_transactions"][1]
    df = spark.range(200_000).selectExpr("id * 7919 % 1000003 AS account_id", "id AS transaction_id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        materialize(df, f"{out}/a", keep_runs=9, cluster_by=["account_id"], bloom_columns=["account_id"], split_by=["transaction_id"])
        materialize(df, f"{out}/b", keep_runs=9, cluster_by=["account_id"], split_by=["transaction_id"])
        hot = df.selectExpr("1 AS account_id", "transaction_id")
        materialize(hot, f"{out}/hot", keep_runs=9, cluster_by=["account_id"], split_by=["transaction_id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    last, ranges = None, []
    for f in files("a"):
        stats = [pq.ParquetFile(f).metadata.row_group(g).column(0).statistics for g in range(pq.ParquetFile(f).metadata.num_row_groups)]
        ranges.append((min(x.min for x in stats), max(x.max for x in stats)))
        keys = pq.read_table(f, columns=["account_id"])["account_id"].to_pylist()
        assert keys == sorted(keys) and (last is None or keys[0] >= last)
        last = keys[-1]
    assert len(ranges) > 4 and all(hi <= lo for (_, hi), (lo, _) in zip(ranges, ranges[1:]))
    size = lambda d: sum(map(os.path.getsize, files(d)))
    assert size("a") > 1.1 * size("b")  # the filters
    rows = [pq.ParquetFile(f).metadata.num_rows for f in files("hot")]
    assert len(rows) > 4 and max(rows) < 60_000  # one key is cut across tasks


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from ledgerline import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_csv_landing_run_with_freshness_gate(spark):
    """Production path: CSV files per raw table -> typed scan -> gates -> all models."""
    from pyspark.sql import functions as F

    from ledgerline.operators.quality import union_all
    from ledgerline.sources import csv_scan

    raw = RawTables(spark, SF)
    landing = tempfile.mkdtemp(prefix="ll-landing-")
    for t in raw.names():
        csv_scan.write_csv(raw[t], t, landing)
    scanned = csv_scan.scan_all(spark, landing)
    log = union_all(
        csv_scan.list_input_files(spark, f"{landing}/{t}").select(F.lit(t).alias("table_name"), F.col("modificationTime").alias("seen_at"))
        for t in scanned
    )
    out = tempfile.mkdtemp(prefix="ll-run-csv-")
    result = runner.run(spark, scanned, out, ingest_log=log)   # files were just written: the gate passes
    assert {r.severity for r in result.gates["freshness"].collect()} == {"ok"}
    kpi = read_table(spark, result.tables["report_monthly_business_kpi"])
    lazy = QUERIES["report_monthly_business_kpi"](spark, SF)
    cols = lazy.columns
    assert rows_digest(cols, [tuple(r) for r in kpi.select(*cols).collect()]) == rows_digest(cols, [tuple(r) for r in lazy.collect()])
