"""Helpers shared by the corpus operators: table access, scratch tables, shared-folder files, row-local "let".

Every operator picks the columns it needs by name and returns only its own columns, so extra columns (also ones that
clash with output names) never matter.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

#: The white space of every word definition here: space and U+0009..U+000D (ASCII white space of bytes.split()).
SPACE = r"[\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers, once per application: its sources as one zip in the shared folder. Where the
    package is installed on the workers, or on their PYTHONPATH, this changes nothing."""
    import io
    import zipfile
    from pathlib import Path

    import ledgerline

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top, packed = Path(ledgerline.__file__).parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, str(Path(top.name) / f.relative_to(top)))
    folder = scratch_path(spark, "code")
    files, path = shared_fs(folder)
    files.create_dir(path, recursive=True)
    write_shared(f"{folder}/{top.name}.zip", packed.getvalue())
    spark.sparkContext.addPyFile(f"{folder}/{top.name}.zip")
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; what reads it may run the package's code on the workers."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: lineage is cut, lost executors lose nothing."""
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once per row: lambdas in ``body`` read the bound value instead of evaluating it again."""
    return F.element_at(F.transform(F.array(value), body), 1)


def prefix_totals(totals: DataFrame, key: str, amount: str, base: str) -> DataFrame:
    """``base`` = sum of ``amount`` over all smaller ``key``. One row per partition comes in, so the single-partition
    window reads as many rows as there are partitions, never rows of the data."""
    from pyspark.sql import Window

    before = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn(base, F.coalesce(F.sum(amount).over(before), F.lit(0)).cast("long"))


def shared_fs(uri: str):
    """(file system, path) of a shared folder; any store that pyarrow knows (file:, hdfs:, s3:...)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


def write_shared(uri: str, data: bytes) -> None:
    """Write one file under a temporary name and rename it: a lost or repeated task never leaves half a file."""
    files, path = shared_fs(uri)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with files.open_output_stream(part) as out:
        out.write(data)
    files.move(part, path)
