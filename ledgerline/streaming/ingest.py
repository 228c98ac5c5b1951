"""Continuous load of arriving CSV files (the auto-ingest pipes).

A file-source stream with the table's string schema, the same typed projection
as the batch scan, plus file metadata, into a Parquet sink. The checkpoint
records which files were taken, so each file is loaded exactly once across
restarts and executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.sources.schemas import REJECT, csv_options, raw_string_schema, typed_columns


def stream_source(
    spark: SparkSession, inbox: str, table: str, permissive: bool = False, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The table's arriving files as strings, with the batch scan's policy for malformed lines."""
    reader = spark.readStream.schema(raw_string_schema(table, permissive)).options(**csv_options(permissive))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(inbox)


def typed_stream(raw: DataFrame, table: str, permissive: bool = False) -> DataFrame:
    """Typed columns (the pipe load's types) plus the source file and its time; permissive: malformed lines stay, with
    their text in ``REJECT``."""
    return raw.select(
        *typed_columns(table, permissive, pipe=True),
        *([F.col(REJECT)] if permissive else []),
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_file_modified_at"),
    )


def start_ingest(
    spark: SparkSession,
    table: str,
    inbox: str,
    sink: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
    permissive: bool = False,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the pipe for ``table``: ``inbox`` CSV files -> Parquet at ``sink``."""
    typed = typed_stream(stream_source(spark, inbox, table, permissive, max_files_per_trigger), table, permissive)
    writer = typed.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=available_now)
    return writer.start()


def ingest_available(
    spark: SparkSession, table: str, inbox: str, sink: str, checkpoint: str, permissive: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Take every file not yet loaded, wait for it, return the sink's well-formed rows."""
    q = start_ingest(
        spark, table, inbox, sink, checkpoint, permissive=permissive, max_files_per_trigger=max_files_per_trigger
    )
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    loaded = spark.read.parquet(sink)
    return loaded.where(F.col(REJECT).isNull()).drop(REJECT) if permissive else loaded


def rejected(spark: SparkSession, sink: str) -> DataFrame:
    """The malformed lines a permissive pipe set aside, with their file."""
    return spark.read.parquet(sink).where(F.col(REJECT).isNotNull()).select(REJECT, "_source_file")


def start_pipes(
    spark: SparkSession,
    landing_root: str,
    raw_root: str,
    checkpoint_root: str,
    tables: list[str] | None = None,
    processing_time: str | None = None,
    permissive: bool = False,
) -> dict[str, StreamingQuery]:
    """One continuous load per raw table: ``landing_root/<t>/*.csv`` -> ``raw_root/<t>`` (Parquet).

    Each table has its own checkpoint under ``checkpoint_root`` (a shared folder on a
    cluster), so every pipe restarts where it stopped and never loads a file twice.
    With ``processing_time`` the pipes keep polling; without it they take what is
    there (available-now) and stop.
    """
    from ledgerline.sources.schemas import RAW_TABLES

    names = tables or list(RAW_TABLES)
    return {
        t: start_ingest(
            spark, t, f"{landing_root.rstrip('/')}/{t}", f"{raw_root.rstrip('/')}/{t}",
            f"{checkpoint_root.rstrip('/')}/{t}", available_now=processing_time is None,
            processing_time=processing_time, permissive=permissive,
        )
        for t in names
    }
