"""All raw tables loaded by one stream.

The source is the stream of arriving files themselves (paths and times; contents are not read there). Each micro-batch
takes at most ``max_files`` new files of any table, reads them with the batch scan's own reader, schema and policy for
malformed lines, and writes every table's rows to a folder named after the batch. So a batch that is repeated after a
failure replaces what its first try left, whatever part of the tables it had reached: each file's rows are there once.
Malformed lines of permissive pipes go to a table of their own.

    <raw_root>/<table>/load_batch=<id>/      typed rows, with _source_file and _file_modified_at
    <raw_root>/rejected_lines/load_batch=<id>/   table_name, line, first_value, _source_file
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.quality import union_all
from ledgerline.sources.schemas import RAW_TABLES, REJECT, csv_options, raw_string_schema
from ledgerline.streaming.ingest import typed_stream

FILES = "path string, modificationTime timestamp, length bigint, content binary"
REJECTED = "rejected_lines"
BATCH = "load_batch"


def arriving_files(spark: SparkSession, landing_root: str, max_files: int = 10_000) -> DataFrame:
    """Streaming (table_name, path, modified_at) of ``landing_root/<table>/*.csv``; the folder names the table."""
    files = (
        spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", max_files)
        .load(f"{landing_root.rstrip('/')}/*")
    )
    return files.select(F.element_at(F.split("path", "/"), -2).alias("table_name"), "path", F.col("modificationTime").alias("modified_at"))


def load_files(spark: SparkSession, table: str, paths: Sequence[str], permissive: bool = False) -> DataFrame:
    """The typed rows of CSV files of one table; permissive: malformed lines stay, with their text in ``REJECT``."""
    raw = spark.read.schema(raw_string_schema(table, permissive)).options(**csv_options(permissive)).csv(list(paths))
    return typed_stream(raw, table, permissive)


def load_batch(files: DataFrame, batch: int, raw_root: str, tables: Sequence[str], permissive: bool = False) -> None:
    """Write one micro-batch: every table's rows to the batch's folder, replacing what an earlier try left there.

    Files of folders that are no raw table are left alone. The list of files is as long as a micro-batch's limit at most.
    """
    spark, of = files.sparkSession, {}
    for r in files.select("table_name", "path").collect():
        of.setdefault(r["table_name"], []).append(r["path"])
    rejects = []
    for table in [t for t in tables if t in of]:
        rows = load_files(spark, table, sorted(of[table]), permissive)
        if permissive:
            bad = rows.where(F.col(REJECT).isNotNull())
            first = F.col(RAW_TABLES[table][0][0]).cast("string").alias("first_value")  # the reader wants a field beside the line
            rejects.append(bad.select(F.lit(table).alias("table_name"), F.col(REJECT).alias("line"), first, "_source_file"))
            rows = rows.where(F.col(REJECT).isNull()).drop(REJECT)
        rows.write.mode("overwrite").parquet(f"{raw_root.rstrip('/')}/{table}/{BATCH}={batch}")
    if rejects:
        union_all(rejects).write.mode("overwrite").parquet(f"{raw_root.rstrip('/')}/{REJECTED}/{BATCH}={batch}")


def start_all(
    spark: SparkSession,
    landing_root: str,
    raw_root: str,
    checkpoint: str,
    tables: Sequence[str] = tuple(RAW_TABLES),
    processing_time: str | None = None,
    permissive: bool = False,
    max_files: int = 10_000,
) -> StreamingQuery:
    """Start the one query that loads all ``tables``. Without ``processing_time`` it takes what is there and stops."""
    writer = arriving_files(spark, landing_root, max_files).writeStream.option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(lambda files, batch: load_batch(files, batch, raw_root, tables, permissive))
    return (writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)).start()


def load_available(spark: SparkSession, landing_root: str, raw_root: str, checkpoint: str, **options) -> None:
    """Load every file that isn't loaded yet, and wait for it; a failed batch raises and is repeated by the next call."""
    q = start_all(spark, landing_root, raw_root, checkpoint, **options)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def loaded_table(spark: SparkSession, raw_root: str, table: str) -> DataFrame:
    """A loaded table's rows, with the batch that loaded each."""
    return spark.read.parquet(f"{raw_root.rstrip('/')}/{table}")
