"""The reference's data-quality bindings, applied to the model graph.

Column tests run one aggregate per model (all bound columns at once, then
unpivoted), so each table is scanned once per test kind.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import labels as L
from ledgerline.functions.timeparse import parse_ts_of
from ledgerline.operators import quality as Q
from ledgerline.plans.models import BankModels
from ledgerline.sources.schemas import TABLE_KEYS

# --- fixed values: test bindings of the source and staging test files -----------
STAGING_NOT_NULL = {
    "stg_pix_movements": ["transaction_id", "account_id", "transaction_amount", "transaction_direction", "status", "transaction_completed_at"],
    "stg_transfer_ins": ["transaction_id", "account_id", "transaction_amount", "transaction_direction"],
    "stg_transfer_outs": ["transaction_id", "account_id", "transaction_direction", "transaction_amount"],
    "stg_accounts": ["account_id", "account_status", "account_created_at"],
    "stg_customers": ["customer_id", "cpf"],
}
STAGING_UNIQUE = {
    "stg_pix_movements": ["transaction_id"],
    "stg_transfer_ins": ["transaction_id"],
    "stg_transfer_outs": ["transaction_id"],
    "stg_accounts": ["account_id"],
    "stg_customers": ["customer_id", "cpf"],
}
ACCEPTED_VALUES = [
    ("stg_pix_movements", "transaction_direction", ["in", "out"]),
    ("stg_transfer_ins", "transaction_direction", ["in"]),
    ("stg_transfer_outs", "transaction_direction", ["out"]),
    ("stg_accounts", "account_status", ["active", "inactive"]),
]
RELATIONSHIPS = [
    ("stg_pix_movements", "account_id", "stg_accounts", "account_id"),
    ("stg_transfer_ins", "account_id", "stg_accounts", "account_id"),
    ("stg_transfer_outs", "account_id", "stg_accounts", "account_id"),
]
RANGE_COLUMNS = [
    ("stg_pix_movements", "transaction_amount"),
    ("stg_transfer_ins", "transaction_amount"),
    ("stg_transfer_outs", "transaction_amount"),
]
ROW_COUNTS = [("stg_pix_movements", 50), ("stg_transfer_ins", 50), ("stg_transfer_outs", 50), ("stg_accounts", 10)]
EXPRESSION_FLOOR = dt.date(2020, 1, 1)


def _model(m: BankModels, name: str) -> DataFrame:
    if name in TABLE_KEYS:
        return m.raw[name]
    return getattr(m, name)


def _not_null_bindings(m: BankModels) -> list[tuple[str, list[str]]]:
    raw = [(t, [k]) for t, k in TABLE_KEYS.items()]
    return raw + list(STAGING_NOT_NULL.items())


FEEDS = {"transfer_ins": "stg_transfer_ins", "transfer_outs": "stg_transfer_outs"}


def transfer_sums(m: BankModels, **sums: Column) -> DataFrame | None:
    """(raw, staged, ...): one row per transfer feed with ``sums`` over its raw rows, all in one pass over the feeds where
    the source has them in one table (None elsewhere). The staged model of a feed is its rows with status ``completed``
    (``kept``), with amount, id and account under other names."""
    both = getattr(m.raw, "transfers", None)
    if both is None or set(FEEDS.values()) & m._overrides.keys():
        return None
    rows = both.select(F.when(F.col("feed") == "in", "transfer_ins").otherwise("transfer_outs").alias("raw"), "id", "account_id", "amount", "status")
    found = rows.groupBy("raw").agg(*[c.alias(n) for n, c in sums.items()])
    listed = both.sparkSession.createDataFrame(list(FEEDS.items()), "raw string, staged string")
    return listed.join(found, "raw", "left").select("raw", "staged", *[F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n) for n in sums])


def kept() -> Column:
    """Raw rows that staging keeps."""
    return F.coalesce(F.col("status") == "completed", F.lit(False))


def not_null_report(m: BankModels) -> DataFrame:
    """model, column_name, failures for every not_null binding (one scan per model; both transfer feeds, raw and staged,
    share one)."""
    frames, shared = [], set()
    sums = transfer_sums(
        m, key=F.count_if(F.col("id").isNull()), **{f"s_{c}": F.count_if(kept() & F.col(c).isNull()) for c in ("id", "account_id", "amount")}
    )
    if sums is not None:
        shared = FEEDS.keys() | set(FEEDS.values())
        cell = lambda model, column, n: F.struct(F.col(model).alias("model"), F.lit(column).alias("column_name"), n.alias("failures"))
        # the direction of a staged transfer is a literal
        cells = [cell("raw", "id", F.col("key")), cell("staged", "transaction_id", F.col("s_id")), cell("staged", "account_id", F.col("s_account_id")),
                 cell("staged", "transaction_amount", F.col("s_amount")), cell("staged", "transaction_direction", F.lit(0).cast("bigint"))]
        frames.append(sums.select(F.inline(F.array(*cells))))
    for model, cols in [b for b in _not_null_bindings(m) if b[0] not in shared]:
        agg = _model(m, model).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        long = agg.unpivot([], cols, "column_name", "failures")
        frames.append(long.select(F.lit(model).alias("model"), "column_name", "failures"))
    return Q.union_all(frames)


def unique_report(m: BankModels) -> DataFrame:
    """Repeated keys per binding. A raw table and the staged model of the same key share one scan and one grouping:
    staging keeps the completed rows, so both counts come from one pass per key."""
    staged_of = {"pix_movements": "stg_pix_movements", "transfer_ins": "stg_transfer_ins", "transfer_outs": "stg_transfer_outs"}
    both = getattr(m.raw, "transfers", None)
    frames, done = [], set()

    def completed(c: str = "status"):
        return F.coalesce(F.col(c) == "completed", F.lit(False))

    def two(df: DataFrame, names) -> DataFrame:
        """(model, column, failures) for the raw key and the staged key of each (raw, staged) pair in ``names``."""
        keys = df.where(F.col("id").isNotNull()).groupBy("raw", "id").agg(F.count(F.lit(1)).alias("n"), F.count_if(completed()).alias("kept"))
        sums = keys.groupBy("raw").agg(F.count_if(F.col("n") > 1).alias("r"), F.count_if(F.col("kept") > 1).alias("s"))
        listed = df.sparkSession.createDataFrame([(r, s) for r, s in names], "raw string, staged string")
        j = listed.join(sums, "raw", "left")
        cell = lambda model, column, n: F.struct(
            model.alias("model"), F.lit(column).alias("column_name"), F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias("failures")
        )
        return j.select(F.inline(F.array(cell(F.col("raw"), "id", "r"), cell(F.col("staged"), "transaction_id", "s"))))

    if both is not None:
        feeds = both.select("id", "status", F.when(F.col("feed") == "in", "transfer_ins").otherwise("transfer_outs").alias("raw"))
        frames.append(two(feeds, [(t, staged_of[t]) for t in ("transfer_ins", "transfer_outs")]))
        done |= {"transfer_ins", "transfer_outs"}
    for t in [t for t in staged_of if t not in done]:
        frames.append(two(m.raw[t].select("id", "status", F.lit(t).alias("raw")), [(t, staged_of[t])]))
    shared = set(staged_of) | set(staged_of.values())
    bindings = [(t, k) for t, k in TABLE_KEYS.items()] + [(t, c) for t, cs in STAGING_UNIQUE.items() for c in cs]
    return Q.union_all(frames + [Q.unique_summary(_model(m, t), t, c) for t, c in bindings if t not in shared])


def accepted_values_report(m: BankModels) -> DataFrame:
    return Q.union_all(Q.accepted_values_failures(_model(m, t), t, c, v) for t, c, v in ACCEPTED_VALUES)


def relationships_report(m: BankModels) -> DataFrame:
    """Staged transactions whose account does not exist, per feed, in one pass over the unified transactions."""
    feeds = {p: f"stg_{p}" for p in ("pix_movements", "transfer_ins", "transfer_outs")}
    name = F.create_map(*[F.lit(x) for pair in feeds.items() for x in pair])[F.col("source_table")]
    rows = m.int_unified_transactions.select("account_id", name.alias("feed"))
    return Q.feed_relationship_summary(rows, "feed", "account_id", m.stg_accounts, "stg_accounts", [t for t, *_ in RELATIONSHIPS])


def accepted_range_report(m: BankModels) -> DataFrame:
    c = F.col("amount")
    sums = transfer_sums(m, failures=F.count_if(kept() & Q.out_of_range(c)))
    if sums is None:
        return Q.union_all(Q.accepted_range_summary(_model(m, t), t, c) for t, c in RANGE_COLUMNS)
    status = Q.severity(F.col("failures"), L.RANGE_WARN_OVER, L.RANGE_ERROR_OVER).alias("status")
    feeds = sums.select(F.col("staged").alias("model"), F.lit("transaction_amount").alias("column_name"), "failures", status)
    return Q.union_all([feeds, *(Q.accepted_range_summary(_model(m, t), t, c) for t, c in RANGE_COLUMNS if t not in FEEDS.values())])


def expression_report(m: BankModels) -> DataFrame:
    pix = m.stg_pix_movements
    ts = F.col("transaction_completed_at")
    floor = F.lit(EXPRESSION_FLOOR).cast("timestamp_ntz")
    today = F.lit(m.as_of).cast("timestamp_ntz")
    return Q.expression_summary(pix, "stg_pix_movements", "transaction_completed_at", ">= '2020-01-01'", ts >= floor).unionByName(
        Q.expression_summary(pix, "stg_pix_movements", "transaction_completed_at", "<= CURRENT_DATE()", ts <= today)
    )


def row_count_report(m: BankModels) -> DataFrame:
    above = dict(ROW_COUNTS)
    sums = transfer_sums(m, n=F.count_if(kept()))
    if sums is None:
        return Q.union_all(Q.row_count_check(_model(m, t), t, above=a) for t, a in ROW_COUNTS)
    limit = F.create_map(*[F.lit(x) for t in FEEDS.values() for x in (t, above[t])])[F.col("staged")]
    feeds = sums.select(*Q.row_count_verdict(F.col("n"), F.col("staged"), limit))
    return Q.union_all([feeds, *(Q.row_count_check(_model(m, t), t, above=a) for t, a in ROW_COUNTS if t not in FEEDS.values())])


def data_date_span(m: BankModels) -> DataFrame:
    """One row: first and last completion date over all transactions."""
    return m.int_unified_transactions.agg(
        F.min(F.to_date("transaction_completed_at")).alias("lo"), F.max(F.to_date("transaction_completed_at")).alias("hi")
    )


def date_spine_of_data(m: BankModels) -> DataFrame:
    return Q.date_spine(F.col("lo"), F.col("hi"), data_date_span(m))


def missing_dates_report(m: BankModels) -> DataFrame:
    """Days of [default_start, as_of] that the calendar lacks; the calendar is all that is read."""
    spine = Q.date_spine(F.lit(m.default_start), F.lit(m.as_of), m.base_time_dimension.sparkSession.range(1))
    return Q.missing_dates(spine, m.base_time_dimension, m.as_of)


def event_log(m: BankModels) -> DataFrame:
    """(table_name, seen_at): the latest event of each feed and of the accounts, from the tables' own rows."""
    raw = {"pix_movements": "pix_requested_at", "transfer_ins": "transaction_requested_at", "transfer_outs": "transaction_requested_at", "accounts": "created_at"}
    frames = []
    for t, c in raw.items():
        df = m.raw[t]
        frames.append(df.agg(F.max(parse_ts_of(df, c)).alias("seen_at")).select(F.lit(t).alias("table_name"), "seen_at"))
    return Q.union_all(frames)


def freshness_report(m: BankModels) -> DataFrame:
    """Freshness against the data's own clock, the latest event of all tables (one row per table)."""
    cats = Q.table_categories(m.base_time_dimension.sparkSession)
    return Q.freshness(event_log(m), cats, as_of=F.max("last_seen").over(Window.partitionBy()))


def low_frequency_counts(m: BankModels) -> DataFrame:
    from ledgerline.functions.labels import TABLE_CLASSES

    return Q.table_counts({t: m.raw[t] for t in TABLE_CLASSES["low_frequency"]})


def non_empty_report(m: BankModels, spark) -> DataFrame:
    return Q.non_empty(low_frequency_counts(m), Q.table_categories(spark))
