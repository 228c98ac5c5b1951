"""The three transaction feeds as one stream: files -> typed -> staged -> unified.

Staging and the union are stateless row operations, so the batch model
functions run unchanged on the streaming DataFrames. The sink is an
append-only Parquet table with a checkpoint: each arriving file is processed
once, and the unified table grows by exactly the rows of the new files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.plans import intermediate as I
from ledgerline.plans import staging as S
from ledgerline.sources.schemas import REJECT
from ledgerline.streaming.ingest import stream_source, typed_stream

FEEDS = ["pix_movements", "transfer_ins", "transfer_outs"]


def unified_stream(spark: SparkSession, inbox_root: str, permissive: bool = False) -> DataFrame:
    """Streaming ``int_unified_transactions`` over ``inbox_root/<feed>/*.csv``."""
    root = inbox_root.rstrip("/")
    typed = {f: typed_stream(stream_source(spark, f"{root}/{f}", f, permissive), f, permissive) for f in FEEDS}
    if permissive:
        typed = {f: df.where(F.col(REJECT).isNull()) for f, df in typed.items()}
    return I.int_unified_transactions(
        S.stg_pix_movements(typed["pix_movements"]),
        S.stg_transfer_ins(typed["transfer_ins"]),
        S.stg_transfer_outs(typed["transfer_outs"]),
    )


def start_unified(
    spark: SparkSession, inbox_root: str, sink: str, checkpoint: str, processing_time: str | None = None
) -> StreamingQuery:
    writer = (
        unified_stream(spark, inbox_root).writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()


def unify_available(spark: SparkSession, inbox_root: str, sink: str, checkpoint: str) -> DataFrame:
    """Process every file not yet taken, then return the unified sink table."""
    q = start_unified(spark, inbox_root, sink, checkpoint)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(sink)
