"""Token counts: batch encoding in an Arrow function that returns lengths only."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (n_tokens > limit).

    The work is per row and needs no shuffle: texts stay where they were read, batches are balanced by bytes and long
    texts are cut at safe boundaries (tokens.py), so neither a long text nor many short ones set a task's memory.
    Null and empty texts: 0 bytes, 0 tokens. Null ids and repeated rows are kept, one output row each. An empty table
    gives an empty result.
    """

    def lengths(batches: Iterator) -> Iterator:
        import pyarrow as pa

        from ledgerline.llm.tokens import encoder, utf8

        enc = encoder(tokenizer)
        for b in batches:
            texts = utf8(b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(map(len, texts), pa.int64()), pa.array(enc.count(texts), pa.int64())],
                [id_col, "n_bytes", "n_tokens"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    counted = docs.select(id_col, text_col).mapInArrow(lengths, f"`{id_col}` {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
