"""Bucketed tables: facts written by account once, joined and aggregated by account without an exchange.

A bucketed table's files hold one hash bucket of the key each, so tables with the same number of buckets meet bucket by
bucket, and a grouping by the key needs no shuffle. A bucket is read by one task, so a key that alone exceeds a bucket's
share would make one task slow: such keys are found when the table is written (by their counts, at most ``2 * buckets`` of
them can exist) and go to a plain part beside the bucketed one. The number of buckets follows the rows (``buckets_for``), so
a task's share doesn't grow with the table. The hot part is aggregated with partial sums and a
shuffle of at most one row per hot key, group and task, and joins by a broadcast of at most ``2 * buckets`` rows.

Bucket specs live in the session's catalog. Files and spec are one folder here: ``attach`` registers an existing folder
in another session's catalog, so a reader needs the path only.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one bucket: its task sorts them, about 250 bytes each, and holds no more groups than these.
ROWS_PER_BUCKET = 500_000
#: The most that Spark allows (``spark.sql.sources.bucketing.maxBuckets``).
MAX_BUCKETS = 100_000


@dataclass(frozen=True)
class Bucketed:
    """A table in two parts: ``cold`` is bucketed by ``key``, ``hot`` holds the rows of the keys listed in ``hot_keys``."""

    key: str
    buckets: int
    cold: DataFrame
    hot: DataFrame
    hot_keys: DataFrame

    def all(self) -> DataFrame:
        return self.cold.unionByName(self.hot)


def buckets_for(rows: int, least: int) -> int:
    """Buckets of a table of ``rows`` rows, at least ``least``."""
    return min(MAX_BUCKETS, max(least, -(-rows // ROWS_PER_BUCKET)))


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key, null included. The counts are partial sums per task; a hot key is one row of each."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def hot_keys(counts: DataFrame, key: str, buckets: int, total: int) -> DataFrame:
    """Keys (not null) that hold more than ``1 / (2 * buckets)`` of the ``total`` rows, and null if it does: at most
    ``2 * buckets`` rows, in one partition. Only they meet in one task, the counts stay where they are."""
    return counts.where(F.col("n") * F.lit(2 * buckets).cast("bigint") > F.lit(total).cast("bigint")).select(key).repartition(1)


def _name(path: str) -> str:
    return f"ledgerline_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, split_hot: bool = True, grow: bool = False) -> Bucketed:
    """Write ``df`` below ``path`` (a new folder) in ``buckets`` buckets of ``key`` and return it read back.

    ``split_hot``: find hot keys first (one more pass over the key column, whose counts are kept beside the table); without
    it every row is in the bucketed part, which fits dimensions whose key is unique. ``grow``: with the counts, more buckets
    than ``buckets`` where the rows need them. Rows with a null key are in a bucket, or hot if they are many. An empty table
    has empty parts.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if split_hot:
        key_counts(df, key).write.parquet(f"{path}/key_counts")
        counts = spark.read.parquet(f"{path}/key_counts")
        total = counts.agg(F.sum("n")).first()[0] or 0  # one number
        buckets = buckets_for(total, buckets) if grow else buckets
        listed = hot_keys(counts, key, buckets, total)
    else:
        listed = df.select(key).limit(0).repartition(1)
    listed.write.parquet(f"{path}/hot_keys")
    known = F.broadcast(spark.read.parquet(f"{path}/hot_keys").select(F.col(key).alias("hot__"), F.lit(True).alias("is_hot__")))
    marked = df.join(known, F.col(key).eqNullSafe(F.col("hot__")), "left")
    cold = marked.where("is_hot__ is null").select(*df.columns)
    # each task's rows are those of one bucket, so a bucket is one file
    cold.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", f"{path}/cold").saveAsTable(_name(path))
    marked.where("is_hot__").select(*df.columns).write.parquet(f"{path}/hot")
    spec = json.dumps({"key": key, "buckets": buckets, "schema": df.schema.json()})
    spark.createDataFrame([(spec,)], "spec string").coalesce(1).write.text(f"{path}/spec")
    return attach(spark, path)


def attach(spark: SparkSession, path: str) -> Bucketed:
    """The table at ``path``, its bucketed part registered in this session's catalog if it isn't yet."""
    from pyspark.sql.types import StructType

    path = path.rstrip("/")
    spec = json.loads(spark.read.text(f"{path}/spec").first()[0])
    schema, key, buckets = StructType.fromJson(json.loads(spec["schema"])), spec["key"], spec["buckets"]
    name = _name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}/cold'")
    read = lambda part: spark.read.schema(schema).parquet(f"{path}/{part}")
    keys = spark.read.schema(StructType([schema[key]])).parquet(f"{path}/hot_keys")
    return Bucketed(key, buckets, spark.table(name), read("hot"), keys)


def drop(spark: SparkSession, table: Bucketed, path: str) -> None:
    """Forget the table in this session's catalog; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(path.rstrip('/'))}")


def grouped(table: Bucketed, by: Sequence[Column | str], aggregates: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """(cold, hot) aggregates by the key and ``by``: the cold part without an exchange. A key is in one part only, so the
    two are disjoint."""
    return tuple(part.groupBy(table.key, *by).agg(*aggregates) for part in (table.cold, table.hot))  # type: ignore[return-value]


def split_by_hot(dimension: Bucketed, hot_of: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A dimension's rows whose key isn't, and is, among the keys of ``hot_of`` (``hot_keys`` of a fact table with the same
    key: at most ``2 * buckets`` rows, so broadcast). The first part keeps the dimension's buckets."""
    keys = F.broadcast(hot_of.select(F.col(hot_of.columns[0]).alias("hot_of__")))
    met = F.col(dimension.key) == F.col("hot_of__")
    return dimension.cold.join(keys, met, "left_anti"), dimension.cold.join(keys, met, "left_semi")
