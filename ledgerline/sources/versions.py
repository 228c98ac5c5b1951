"""Versioned tables: data in version folders, a publish log that readers resolve.

A root folder holds ``data/<table>/<version>/`` (the files of one write) and ``log/`` (one small Parquet file per publish,
with one row per table it switches). A writer stages any number of tables and publishes them together: the log file
appears as a whole or not at all, so a reader sees every table of a publish or none, never a gap, and a failure at any
moment leaves what was published before. A rollback is a publish of older versions. Old versions stay readable (also for
readers that resolved them before a publish) until ``vacuum`` removes them.

Only ``vacuum`` deletes; nothing is renamed or overwritten, so this holds on object stores too. One writer per root is
expected; two that publish at once are told apart by ``ConcurrentPublish`` in the second.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LOG = "run long, run_id string, table_name string, version string, published_at timestamp, note string"
#: Bounds file size whatever the partition sizes are.
MAX_RECORDS_PER_FILE = 5_000_000


class ConcurrentPublish(RuntimeError):
    """Another writer published the same run number."""


class VersionedTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        #: Written and not yet published: table -> version.
        self.staged: dict[str, str] = {}

    # -- reading -------------------------------------------------------------------
    def history(self) -> DataFrame:
        """Every publish: run, run_id, table_name, version, published_at, note."""
        if not _exists(self.spark, f"{self.root}/log"):
            return self.spark.createDataFrame([], LOG)
        return self.spark.read.schema(LOG).parquet(f"{self.root}/log")

    def current(self, run: int | None = None) -> DataFrame:
        """One row per table: its version as of ``run`` (default: the latest)."""
        rows = self.history() if run is None else self.history().where(F.col("run") <= run)
        latest = Window.partitionBy("table_name").orderBy(F.desc("run"), "run_id")
        return rows.withColumn("k", F.row_number().over(latest)).where("k = 1").drop("k")

    def resolve(self, table: str, run: int | None = None) -> str:
        """Folder of the table's published version."""
        row = self.current(run).where(F.col("table_name") == table).first()
        if row is None:
            raise FileNotFoundError(f"no published version of {table} in {self.root}")
        return self._folder(table, row["version"])

    def read(self, table: str, run: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self.resolve(table, run))

    def read_staged(self, table: str) -> DataFrame:
        """What this writer has staged, for the models and tests of the same run."""
        return self.spark.read.parquet(self._folder(table, self.staged[table]))

    def _folder(self, table: str, version: str) -> str:
        return f"{self.root}/data/{table}/{version}"

    # -- writing -------------------------------------------------------------------
    def stage(
        self,
        df: DataFrame,
        table: str,
        cluster_by: Sequence[str] = (),
        bloom_columns: Sequence[str] = (),
        split_by: Sequence[str] = (),
        partition_by: Sequence[str] = (),
        files_per_write: int | None = None,
        max_records_per_file: int = MAX_RECORDS_PER_FILE,
        expand: Callable[[DataFrame], DataFrame] | None = None,
    ) -> DataFrame:
        """Write a new version of ``table`` and return it read back; readers don't see it before ``publish``.

        ``cluster_by`` becomes a range partitioning plus a sort within each file; ``split_by`` adds a unique tie-break to
        the range keys, so one hot cluster-key value is cut across many tasks; files stay sorted by the cluster keys
        first. ``max_records_per_file`` bounds file size whatever the partition sizes are.

        ``expand`` makes the table's rows from the clustered rows of ``df``, each its own (no shuffle): few rows are
        sampled, shuffled and sorted where each of them stands for many of the table.
        """
        out = df
        if cluster_by:
            keys = [*cluster_by, *split_by]
            out = out.repartitionByRange(files_per_write, *keys) if files_per_write else out.repartitionByRange(*keys)
            out = out.sortWithinPartitions(*keys)
        out = expand(out) if expand else out
        writer = out.write.option("maxRecordsPerFile", max_records_per_file)
        for c in bloom_columns:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        version = f"v{dt.datetime.now(dt.UTC):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        folder = self._folder(table, version)
        try:
            writer.parquet(folder)
        except Exception:
            _delete(self.spark, folder)
            raise
        self.staged[table] = version
        return self.read_staged(table)

    def publish(self, note: str = "") -> int:
        """Switch every staged table at once; returns the run number."""
        if not self.staged:
            raise ValueError("nothing is staged")
        run = self._append(self.staged, note)
        self.staged = {}
        return run

    def rollback(self, run: int, tables: Sequence[str] = ()) -> int:
        """Publish again what ``tables`` (default: all) were as of ``run``."""
        rows = self.current(run).collect()  # one row per table
        versions = {r["table_name"]: r["version"] for r in rows if not tables or r["table_name"] in tables}
        if not versions:
            raise FileNotFoundError(f"nothing was published by run {run} in {self.root}")
        return self._append(versions, f"rollback to run {run}")

    def discard(self) -> None:
        """Remove what is staged and not published."""
        for table, version in self.staged.items():
            _delete(self.spark, self._folder(table, version))
        self.staged = {}

    def _append(self, versions: dict[str, str], note: str) -> int:
        run = (self.history().agg(F.max("run")).first()[0] or 0) + 1
        run_id, now = uuid.uuid4().hex, dt.datetime.now()
        rows = [(run, run_id, t, v, now, note) for t, v in versions.items()]
        # one task, one file: its commit is the switch
        self.spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(f"{self.root}/log")
        rival = self.history().where((F.col("run") == run) & (F.col("run_id") < run_id)).first()
        if rival is not None:
            raise ConcurrentPublish(f"run {run} of {self.root} was published by another writer, whose versions count")
        return run

    def vacuum(self, keep_runs: int = 2) -> list[str]:
        """Delete versions that none of the last ``keep_runs`` runs (at least one) resolves to; returns their folders.
        Staged versions stay, and so does anything that isn't a version folder of a table in the log."""
        last = self.history().agg(F.max("run")).first()[0] or 0
        kept = {(r["table_name"], r["version"]) for k in range(max(1, keep_runs)) if last - k >= 1 for r in self.current(last - k).collect()}
        kept |= set(self.staged.items())
        named = {(r["table_name"], r["version"]) for r in self.history().select("table_name", "version").distinct().collect()}
        gone = [self._folder(*x) for x in sorted(named - kept) if _exists(self.spark, self._folder(*x))]
        for folder in gone:
            _delete(self.spark, folder)
        return gone


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _exists(spark: SparkSession, path: str) -> bool:
    fs, where = _path(spark, path)
    return fs.exists(where)


def _delete(spark: SparkSession, path: str) -> None:
    fs, where = _path(spark, path)
    fs.delete(where, True)
