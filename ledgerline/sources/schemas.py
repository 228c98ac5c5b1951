"""The 13 raw tables: positional CSV layout and typed projection.

Files are read with an all-string schema (no inference), then each column is
cast by position to its declared type. ``ts_marker`` columns treat the text
``None`` as missing and parse tolerantly; ``ts`` columns are cast strictly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.timeparse import null_marker, parse_ts

DECIMAL = "decimal(18,2)"

# --- fixed values: the raw tables' columns and types, in CSV position order ---
RAW_TABLES: dict[str, list[tuple[str, str]]] = {
    "pix_movements": [
        ("id", "bigint"), ("account_id", "bigint"), ("pix_amount", DECIMAL),
        ("pix_requested_at", "ts_marker"), ("pix_completed_at", "ts_marker"),
        ("status", "string"), ("in_or_out", "string"),
    ],
    "transfer_ins": [
        ("id", "bigint"), ("account_id", "bigint"), ("amount", DECIMAL),
        ("transaction_requested_at", "string"), ("transaction_completed_at", "string"),
        ("status", "string"),
    ],
    "transfer_outs": [
        ("id", "bigint"), ("account_id", "bigint"), ("amount", DECIMAL),
        ("transaction_requested_at", "string"), ("transaction_completed_at", "string"),
        ("status", "string"),
    ],
    "accounts": [
        ("account_id", "bigint"), ("account_name", "string"), ("created_at", "ts"), ("status", "string"),
    ],
    "customers": [
        ("customer_id", "bigint"), ("first_name", "string"), ("last_name", "string"),
        ("customer_city", "bigint"), ("cpf", "bigint"), ("country_name", "string"),
    ],
    "city": [("city_name", "string"), ("state_id", "bigint"), ("city_id", "bigint")],
    "state": [("state", "string"), ("country_id", "int"), ("state_id", "int")],
    "country": [("country", "string"), ("country_id", "bigint")],
    "d_time": [
        ("time_id", "bigint"), ("action_timestamp", "string"), ("week_id", "int"),
        ("month_id", "int"), ("year_id", "int"), ("weekday_id", "int"),
    ],
    "d_week": [("week_id", "int"), ("action_week", "int")],
    "d_month": [("month_id", "int"), ("action_month", "bigint")],
    "d_year": [("year_id", "int"), ("action_year", "int")],
    "d_weekday": [("weekday_id", "int"), ("action_weekday", "string")],
}

# Columns that the pipe load types as timestamps, though the external tables keep their text.
PIPE_TIMES = {"transaction_requested_at", "transaction_completed_at"}
# Where a malformed line's text goes in permissive reads.
REJECT = "_rejected_line"

# Declared key of each table (not_null + unique in the source tests).
TABLE_KEYS = {
    "accounts": "account_id", "pix_movements": "id", "city": "city_id", "country": "country_id",
    "customers": "customer_id", "d_month": "month_id", "d_time": "time_id", "d_week": "week_id",
    "d_weekday": "weekday_id", "d_year": "year_id", "state": "state_id",
    "transfer_ins": "id", "transfer_outs": "id",
}


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), DECIMAL: T.DecimalType(18, 2),
    "ts": T.TimestampNTZType(), "ts_marker": T.TimestampNTZType(),
}


def _spark_type(kind: str) -> str:
    return {"ts": "timestamp_ntz", "ts_marker": "timestamp_ntz"}.get(kind, kind)


def raw_string_schema(table: str, permissive: bool = False) -> T.StructType:
    """All-string schema in CSV position order (what the files physically hold); permissive: and ``REJECT``."""
    names = [name for name, _ in RAW_TABLES[table]] + [REJECT] * permissive
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names])


def csv_options(permissive: bool) -> dict[str, str]:
    """One policy for lines with too few or too many fields, in batch scans and streams: strict reads fail, permissive
    reads set the whole line aside in ``REJECT``."""
    mode = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECT} if permissive else {"mode": "FAILFAST"}
    # without column pruning, so that a line is judged as a whole whatever columns a query picks
    return {"header": "true", "pathGlobFilter": "*.csv", "recursiveFileLookup": "true", "columnPruning": "false", **mode}


def typed_schema(table: str) -> T.StructType:
    return T.StructType(
        [T.StructField(name, _TYPES[kind], True) for name, kind in RAW_TABLES[table]]
    )


def _typed_column(name: str, kind: str, permissive: bool) -> Column:
    col = F.col(name)
    if kind == "string":
        return col.alias(name)
    if kind == "ts_marker":
        return parse_ts(null_marker(col), T.StringType()).alias(name)
    target = _spark_type(kind)
    return (col.try_cast(target) if permissive else col.cast(target)).alias(name)


def typed_columns(table: str, permissive: bool = False, pipe: bool = False) -> list[Column]:
    """The declared columns of ``table`` cast from their string form, in order; ``pipe``: with the pipe load's types."""
    kinds = [(n, "ts_marker" if pipe and n in PIPE_TIMES else k) for n, k in RAW_TABLES[table]]
    return [_typed_column(n, k, permissive) for n, k in kinds]


def typed_projection(strings: DataFrame, table: str, permissive: bool = False) -> DataFrame:
    """Cast an all-string frame to the table's declared types.

    Strict mode raises on a malformed number (like the warehouse's ``::BIGINT`` and
    ``TO_DECIMAL``); permissive mode turns it into NULL instead.
    """
    return strings.select(*typed_columns(table, permissive))


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select and cast an already-typed frame to the declared layout (casts only where needed)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = [
        F.col(f.name) if have.get(f.name) == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name)
        for f in typed_schema(table).fields
    ]
    return df.select(*cols)
