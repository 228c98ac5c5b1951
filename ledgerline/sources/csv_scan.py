"""Batch CSV scan, raw preview, file listing and CSV export of the raw tables.

Layout per table: ``<root>/<table>/**/*.csv`` with one header line, columns by
position. Reading never infers a schema: files are read as strings and cast by
``typed_projection``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.schemas import RAW_TABLES, REJECT, csv_options, raw_string_schema, typed_projection


def read_raw_strings(spark: SparkSession, root: str, table: str, permissive: bool = False) -> DataFrame:
    """The positional string columns as they sit in the files; permissive: malformed lines in ``REJECT``."""
    reader = spark.read.schema(raw_string_schema(table, permissive)).options(**csv_options(permissive))
    return reader.csv(f"{root.rstrip('/')}/{table}")


def scan_table(spark: SparkSession, root: str, table: str, permissive: bool = False) -> DataFrame:
    """Typed external-table scan of one table: strict casts and lines, or, ``permissive``, NULL for malformed numbers
    and without malformed lines (see ``rejected_lines``)."""
    rows = read_raw_strings(spark, root, table, permissive)
    return typed_projection(rows.where(F.col(REJECT).isNull()) if permissive else rows, table, permissive)


def rejected_lines(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The malformed lines a permissive scan sets aside, with their first field and file."""
    rows = read_raw_strings(spark, root, table, True).select("*", F.col("_metadata.file_path").alias("_source_file"))
    return rows.where(F.col(REJECT).isNotNull()).select(RAW_TABLES[table][0][0], REJECT, "_source_file")


def scan_all(spark: SparkSession, root: str, permissive: bool = False) -> dict[str, DataFrame]:
    return {t: scan_table(spark, root, t, permissive) for t in RAW_TABLES}


def raw_preview(spark: SparkSession, root: str, table: str, n: int = 5, order_by: str | None = None) -> DataFrame:
    """First ``n`` rows of the untyped files (ordered by ``order_by`` for a stable pick)."""
    raw = read_raw_strings(spark, root, table)
    if order_by:
        raw = raw.orderBy(F.col(order_by).cast("bigint"), *[c for c in raw.columns if c != order_by])
    return raw.limit(n)


def list_input_files(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """``LIST @stage``: path, size and modification time of the matching files.

    The binary file source reads only metadata when ``content`` is not selected.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length", "modificationTime")
    )


def rows_per_table(spark: SparkSession, root: str, tables: list[str]) -> DataFrame:
    """Data lines (without headers) of the listed files below ``root/<table>/``, per table."""
    where = [f"{root.rstrip('/')}/{t}" for t in tables]
    lines = spark.read.option("pathGlobFilter", "*.csv").text(where).select(F.col("_metadata.file_path").alias("path"))
    per_file = lines.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    table = F.regexp_extract("path", "/([^/]+)/[^/]+$", 1).alias("table_name")
    return per_file.groupBy(table).agg(F.sum(F.col("n") - 1).alias("n_rows"))


def to_csv_strings(df: DataFrame, table: str) -> DataFrame:
    """Typed raw table -> the string layout the files hold (``None`` marks a missing time)."""
    cols = []
    for name, kind in RAW_TABLES[table]:
        text = F.col(name).cast("string")
        if kind == "ts_marker":
            text = F.coalesce(text, F.lit("None"))
        cols.append(text.alias(name))
    return df.select(*cols)


def write_csv(df: DataFrame, table: str, root: str, mode: str = "overwrite") -> str:
    """Write a typed raw table as header CSV below ``root/table`` (spaces kept as data)."""
    path = f"{root.rstrip('/')}/{table}"
    (
        to_csv_strings(df, table)
        .write.mode(mode)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path
