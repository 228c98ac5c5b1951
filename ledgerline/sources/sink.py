"""Table materialization: full rebuilds as new versions, published when complete (``versions.py``).

``cluster_by`` becomes a range partitioning plus a sort within each file, so
Parquet min/max statistics skip row groups for filters on those keys;
``bloom_columns`` add Parquet bloom filters for point lookups (the reference's
post-hook index). Written tables also cut lineage: reading them back starts a
fresh plan, which is how long pipelines survive executor loss without
recomputing from the sources.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.versions import VersionedTables


def with_metadata(df: DataFrame, loaded_at: dt.datetime | None = None, processed: bool = False) -> DataFrame:
    """Append the audit columns: ``_loaded_at`` (the given load time) and ``_processed_at`` (now)."""
    cols = [F.col(c) for c in df.columns]
    if loaded_at is not None:
        cols.append(F.lit(loaded_at).cast("timestamp").alias("_loaded_at"))
    if processed:
        cols.append(F.current_timestamp().alias("_processed_at"))
    return df.select(*cols)


def materialize(df: DataFrame, path: str, keep_runs: int = 2, **layout) -> DataFrame:
    """Rebuild the table at ``path`` (its parent folder is the tables' root) and return it read back.

    The new version is published when it is complete: until then, and after a failed write, readers have the old one.
    The versions of the last ``keep_runs`` publishes of the root stay readable. ``layout``: see ``VersionedTables.stage``.
    """
    tables, name = _table(df.sparkSession, path)
    tables.stage(df, name, **layout)
    tables.publish()
    tables.vacuum(keep_runs)
    return tables.read(name)


def read_table(spark: SparkSession, path: str, run: int | None = None) -> DataFrame:
    """The published table at ``path``, as of ``run`` (default: the latest)."""
    tables, name = _table(spark, path)
    return tables.read(name, run)


def _table(spark: SparkSession, path: str) -> tuple[VersionedTables, str]:
    root, _, name = path.rstrip("/").rpartition("/")
    return VersionedTables(spark, root), name
