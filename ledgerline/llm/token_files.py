"""Token-ID output: flat unsigned integer files with 64-bit document offsets, read through memory maps.

Layout of a folder:

* ``shard-00000.bin``  ids of the shard's documents, one after the other, little-endian; 16 bits wide if every id fits,
  else 32 bits (``manifest.width`` bytes)
* ``shard-00000.idx``  n_docs + 1 little-endian int64 offsets (in ids) into the ``.bin`` file
* ``shard-00000.doc``  n_docs little-endian int64 document ids (a null id is ``NULL_ID``)
* ``manifest``         Parquet: shard, n_docs, n_tokens, width, base; ``base`` (ids in all earlier shards) comes from
  prefix sums over the shards' totals, so an id's global position is ``base`` + its offset

Shards are ranges of the document id, in ascending order; inside, documents ascend too.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import prefix_totals, shared_fs, write_shared

NULL_ID = -(2**63)


def in_id_order(docs: DataFrame, partitions: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) range-partitioned and sorted by id, nulls last; rows of one id by a hash of the text, then the
    text, so that repeated ids have one order and a hot id is cut across partitions. Null texts become empty."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie").asc()]
    ranged = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order, F.col("text").asc()).select("doc_id", "text")


def write_token_files(docs: DataFrame, out_dir: str, tokenizer: str, end_id: int = 2, shards: int | None = None) -> DataFrame:
    """Encode whole texts, append ``end_id`` to each document and write the files; returns the manifest.

    One shuffle (the range sort). ``shards`` None: the session's shuffle partitions, coalesced by size. A task holds
    one shard's document ids and lengths; ids go to the file batch by batch. Null and empty texts hold ``end_id`` only;
    repeated ids and rows are all written; null ids come last. Files get their final name when complete, and a
    repeated task writes the same bytes.
    """

    def write(batches: Iterator) -> Iterator:
        import uuid

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        from ledgerline.llm.tokens import encoder, utf8

        enc, shard = encoder(tokenizer), TaskContext.get().partitionId()
        width = 2 if max(enc.size, end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], "<u4").tobytes()
        files, path = shared_fs(f"{out_dir}/shard-{shard:05d}")
        part, out, ids, sizes = f"{path}.bin.{uuid.uuid4().hex}.part", None, [], []
        for b in batches:
            if b.num_rows == 0:
                continue
            out = out or files.open_output_stream(part)
            ids.append(b.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype("<i8"))
            coded = [x + end for x in enc.encode(utf8(b.column(1)))]
            sizes.append(np.fromiter((len(x) // 4 for x in coded), "<i8", len(coded)))
            out.write(np.frombuffer(b"".join(coded), "<u4").astype(f"<u{width}").tobytes())
        n_docs = n_tokens = 0
        if out:
            out.close()
            files.move(part, f"{path}.bin")
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype("<i8")
            write_shared(f"{out_dir}/shard-{shard:05d}.idx", offsets.tobytes())
            write_shared(f"{out_dir}/shard-{shard:05d}.doc", np.concatenate(ids).tobytes())
            n_docs, n_tokens = len(offsets) - 1, int(offsets[-1])
        yield pa.RecordBatch.from_pydict({"shard": [shard], "n_docs": [n_docs], "n_tokens": [n_tokens], "width": [width]})

    spark = docs.sparkSession
    spark_makedirs(out_dir)
    shards_of = in_id_order(docs, shards).mapInArrow(write, "shard long, n_docs long, n_tokens long, width long")
    shards_of.write.mode("overwrite").parquet(f"{out_dir}/totals")
    totals = spark.read.parquet(f"{out_dir}/totals").where("n_docs > 0")
    prefix_totals(totals, "shard", "n_tokens", "base").write.mode("overwrite").parquet(f"{out_dir}/manifest")
    return spark.read.parquet(f"{out_dir}/manifest")


def spark_makedirs(uri: str) -> None:
    files, path = shared_fs(uri)
    files.create_dir(path, recursive=True)


def mapped(uri: str, kind: str):
    """A file as a read-only array: a memory map on a local or mounted folder, else one read."""
    import numpy as np
    from pyarrow import fs

    files, path = shared_fs(uri)
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with files.open_input_file(path) as f:
        return np.frombuffer(f.read(), kind)


def read_token_files(spark: SparkSession, out_dir: str, with_ids: bool = True) -> DataFrame:
    """Documents from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers) and, ``with_ids``, those bytes as ``ids``. One task per shard or less; a
    task maps its shard and touches one document at a time."""

    def read(batches: Iterator) -> Iterator:
        from zlib import crc32

        import pyarrow as pa

        for b in batches:
            for row in b.to_pylist():
                name = f"{out_dir}/shard-{row['shard']:05d}"
                ids, offsets, docs = mapped(f"{name}.bin", f"<u{row['width']}"), mapped(f"{name}.idx", "<i8"), mapped(f"{name}.doc", "<i8")
                k, n = 0, len(docs)
                while k < n:  # batches of about 1M ids
                    e = max(k + 1, min(n, int(offsets.searchsorted(offsets[k] + (1 << 20), "right")) - 1))
                    coded = [ids[offsets[i] : offsets[i + 1]].astype("<u4").tobytes() for i in range(k, e)]
                    cols = {
                        "doc_id": pa.array([None if d == NULL_ID else int(d) for d in docs[k:e]], pa.int64()),
                        "start": pa.array(offsets[k:e] + row["base"], pa.int64()),
                        "n_tokens": pa.array(offsets[k + 1 : e + 1] - offsets[k:e], pa.int64()),
                        "ids_crc32": pa.array([crc32(x) for x in coded], pa.int64()),
                    }
                    if with_ids:
                        cols["ids"] = pa.array(coded, pa.binary())
                    yield pa.RecordBatch.from_pydict(cols)
                    k = e

    manifest = spark.read.parquet(f"{out_dir}/manifest")
    spread = manifest.repartition(max(1, manifest.count()))
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else ""))
