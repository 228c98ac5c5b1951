"""Packing: concatenate and cut.

Pass 1 encodes the documents in id order, partition by partition, and stores each document's ids with its token offset
inside the partition. Prefix sums over the partitions' totals give each partition its global offset, so every token's
place in the concatenation of all documents is known without moving a token. Pass 2 cuts at fixed windows: a document
that crosses a window's end gets one record on each side.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import prefix_totals, stored
from ledgerline.llm.token_files import in_id_order

ENCODED = "part long, pos long, doc_id long, n_tokens long, ids binary"


def encode_in_order(docs: DataFrame, tokenizer: str, end_id: int, partitions: int | None = None) -> DataFrame:
    """One row per document in id order: partition, token offset in it, ids (with ``end_id``) as little-endian uint32."""

    def encode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from ledgerline.llm.tokens import encoder, utf8

        enc, part, pos = encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            for k in range(0, b.num_rows, 512):
                some = b.slice(k, 512)
                ids = [x + end for x in enc.encode(utf8(some.column(1)))]
                n = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
                ends = pos + np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part)), pa.array(ends - n), some.column(0), pa.array(n), pa.array(ids, pa.binary())],
                    ["part", "pos", "doc_id", "n_tokens", "ids"],
                )
                pos = int(ends[-1])

    return in_id_order(docs, partitions).mapInArrow(encode, ENCODED)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = 4096, partitions: int | None = None) -> DataFrame:
    """Pieces of full windows: doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian uint32).

    All sequences but the last hold exactly ``window`` ids; sequence ids count from 0 without gaps. One shuffle (the
    range sort by id); the encoded documents are stored once in the shared folder, and pass 2 is row-local apart from
    the join with one row per partition. Null and empty texts give one piece with ``end_id``; repeated ids and rows are
    packed each; null ids come last; an empty table gives no pieces.
    """
    coded = stored(encode_in_order(docs, tokenizer, end_id, partitions), "packed")
    totals = coded.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # broadcast: one row per partition of the sort, whatever the data
    bases = F.broadcast(prefix_totals(totals, "part", "total", "base").select("part", "base"))
    first = F.col("base") + F.col("pos")
    placed = coded.join(bases, "part").select("doc_id", "n_tokens", "ids", first.alias("first"))
    w, last = F.lit(window), F.col("first") + F.col("n_tokens") - 1

    def piece(k):
        begin, end = F.greatest(k * w, F.col("first")), F.least((k + 1) * w, F.col("first") + F.col("n_tokens"))
        start = begin - F.col("first")
        return F.struct(
            start.alias("start"),
            (end - begin).alias("length"),
            k.alias("sequence_id"),
            (begin - k * w).alias("offset"),
            F.substring(F.col("ids"), (start * 4 + 1).cast("int"), ((end - begin) * 4).cast("int")).alias("ids"),
        )

    windows = F.sequence(F.floor(F.col("first") / w), F.floor(last / w))
    # the pieces are cut inside one expression: a long document's ids are copied once in all, not once per piece
    cuts = placed.select("doc_id", F.col("n_tokens").alias("doc_tokens"), F.inline(F.transform(windows, piece)))
    return cuts.select("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")
