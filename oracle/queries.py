"""Oracle SQL per registered query key (DuckDB, over the driver's views)."""

from __future__ import annotations

from oracle.sql import AS_OF, DEFAULT_START, build, model, parse_ts

# --- fixed values: raw tables, keys and test bindings ---
RAW = [
    "pix_movements", "transfer_ins", "transfer_outs", "accounts", "customers", "city", "state", "country",
    "d_time", "d_week", "d_month", "d_year", "d_weekday",
]
TABLE_KEYS = {
    "accounts": "account_id", "pix_movements": "id", "city": "city_id", "country": "country_id",
    "customers": "customer_id", "d_month": "month_id", "d_time": "time_id", "d_week": "week_id",
    "d_weekday": "weekday_id", "d_year": "year_id", "state": "state_id",
    "transfer_ins": "id", "transfer_outs": "id",
}
STAGING_NOT_NULL = {
    "stg_pix_movements": ["transaction_id", "account_id", "transaction_amount", "transaction_direction", "status", "transaction_completed_at"],
    "stg_transfer_ins": ["transaction_id", "account_id", "transaction_amount", "transaction_direction"],
    "stg_transfer_outs": ["transaction_id", "account_id", "transaction_direction", "transaction_amount"],
    "stg_accounts": ["account_id", "account_status", "account_created_at"],
    "stg_customers": ["customer_id", "cpf"],
}
STAGING_UNIQUE = [
    ("stg_pix_movements", "transaction_id"), ("stg_transfer_ins", "transaction_id"),
    ("stg_transfer_outs", "transaction_id"), ("stg_accounts", "account_id"),
    ("stg_customers", "customer_id"), ("stg_customers", "cpf"),
]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _not_null() -> str:
    bindings = [(t, [k]) for t, k in TABLE_KEYS.items()] + list(STAGING_NOT_NULL.items())
    parts = [
        f"SELECT '{t}' AS model, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS failures FROM {t}"
        for t, cols in bindings for c in cols
    ]
    return build(_union(parts))


def _unique() -> str:
    bindings = list(TABLE_KEYS.items()) + STAGING_UNIQUE
    parts = [
        f"SELECT '{t}' AS model, '{c}' AS column_name, COUNT(*) AS failures "
        f"FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1)"
        for t, c in bindings
    ]
    return build(_union(parts))


def _accepted_values() -> str:
    bindings = [
        ("stg_pix_movements", "transaction_direction", ["in", "out"]),
        ("stg_transfer_ins", "transaction_direction", ["in"]),
        ("stg_transfer_outs", "transaction_direction", ["out"]),
        ("stg_accounts", "account_status", ["active", "inactive"]),
    ]
    parts = []
    for t, c, vals in bindings:
        lst = ", ".join(f"'{v}'" for v in vals)
        parts.append(
            f"SELECT '{t}' AS model, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, COUNT(*) AS n_records "
            f"FROM {t} WHERE {c} NOT IN ({lst}) GROUP BY {c}"
        )
    return build(_union(parts))


def _relationships() -> str:
    parts = []
    for t in ["stg_pix_movements", "stg_transfer_ins", "stg_transfer_outs"]:
        parts.append(
            f"SELECT '{t}' AS model, 'account_id' AS column_name, 'stg_accounts' AS to_model, "
            f"CAST(COUNT(*) AS BIGINT) AS failing_rows, COUNT(DISTINCT child.account_id) AS failing_keys "
            f"FROM {t} child LEFT JOIN (SELECT DISTINCT account_id FROM stg_accounts) parent "
            f"ON child.account_id = parent.account_id "
            f"WHERE child.account_id IS NOT NULL AND parent.account_id IS NULL"
        )
    return build(_union(parts))


def _accepted_range() -> str:
    parts = []
    for t in ["stg_pix_movements", "stg_transfer_ins", "stg_transfer_outs"]:
        f = "COUNT(*) FILTER (WHERE transaction_amount < 0.01 OR transaction_amount > 1000000)"
        parts.append(
            f"SELECT '{t}' AS model, 'transaction_amount' AS column_name, {f} AS failures, "
            f"CASE WHEN {f} > 50 THEN 'error' WHEN {f} > 0 THEN 'warn' ELSE 'pass' END AS status FROM {t}"
        )
    return build(_union(parts))


def _expression() -> str:
    col = "transaction_completed_at"
    return build(_union([
        f"SELECT 'stg_pix_movements' AS model, '{col}' AS column_name, '>= ''2020-01-01''' AS expression, "
        f"COUNT(*) FILTER (WHERE NOT ({col} >= TIMESTAMP '2020-01-01 00:00:00')) AS failures FROM stg_pix_movements",
        f"SELECT 'stg_pix_movements', '{col}', '<= CURRENT_DATE()', "
        f"COUNT(*) FILTER (WHERE NOT ({col} <= CAST({AS_OF} AS TIMESTAMP))) FROM stg_pix_movements",
    ]))


def _row_count() -> str:
    parts = [
        f"SELECT COUNT(*) AS actual_count, CAST({a} AS BIGINT) AS min_expected, CAST(NULL AS BIGINT) AS max_expected, "
        f"'{t}' AS model_name, CASE WHEN COUNT(*) < {a} THEN 'TOO_FEW_ROWS' END AS error_type FROM {t}"
        for t, a in [("stg_pix_movements", 50), ("stg_transfer_ins", 50), ("stg_transfer_outs", 50), ("stg_accounts", 10)]
    ]
    return build(_union(parts))


def _raw_preview() -> str:
    return build(
        "SELECT CAST(id AS VARCHAR) AS id, CAST(account_id AS VARCHAR) AS account_id, CAST(pix_amount AS VARCHAR) AS pix_amount, "
        "COALESCE(CAST(pix_requested_at AS VARCHAR), 'None') AS pix_requested_at, "
        "COALESCE(CAST(pix_completed_at AS VARCHAR), 'None') AS pix_completed_at, status, in_or_out "
        "FROM pix_movements ORDER BY CAST(id AS BIGINT) LIMIT 5"
    )


def _parse_null_marker() -> str:
    cleaned = "NULLIF(transaction_completed_at, 'None')"
    return build(
        f"SELECT id AS transaction_id, transaction_completed_at AS raw_value, {parse_ts(cleaned)} AS parsed_at, "
        f"({cleaned}) IS NULL AS is_missing FROM transfer_ins"
    )


def _date_spine() -> str:
    return build(
        "SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS expected_date FROM ("
        "SELECT min(CAST(transaction_completed_at AS DATE)) AS lo, max(CAST(transaction_completed_at AS DATE)) AS hi "
        "FROM int_unified_transactions)"
    )


def _missing_dates() -> str:
    return build(
        f"SELECT ds.expected_date FROM (SELECT CAST(unnest(generate_series({DEFAULT_START}, {AS_OF}, INTERVAL 1 DAY)) AS DATE) AS expected_date) ds "
        f"LEFT JOIN base_time_dimension td ON ds.expected_date = td.utc_date "
        f"WHERE td.utc_date IS NULL AND ds.expected_date <= {AS_OF}"
    )


def _non_empty() -> str:
    lows = ["city", "country", "state", "d_time", "d_month", "d_week", "d_weekday", "d_year"]
    counts = _union([f"SELECT '{t}' AS table_name, COUNT(*) AS record_count FROM {t}" for t in lows])
    return build(
        "SELECT table_name, 'low_frequency' AS category, record_count, record_count > 0 AS has_data, "
        "CASE WHEN record_count > 0 THEN 'ok' ELSE 'warning' END AS severity FROM (" + counts + ")"
    )


ORACLE: dict[str, str] = {}
for _t in RAW:
    ORACLE[f"scan_{_t}"] = model(_t)
ORACLE["parse_null_marker"] = _parse_null_marker()
ORACLE["raw_preview"] = _raw_preview()
ORACLE["stream_ingest_pix"] = model("pix_movements")
for _t in ("transfer_ins", "transfer_outs"):
    _asked, _done = (parse_ts(f"NULLIF({c}, 'None')") for c in ("transaction_requested_at", "transaction_completed_at"))
    ORACLE[f"stream_ingest_{_t}"] = build(
        f"SELECT id, account_id, amount, {_asked} AS transaction_requested_at, {_done} AS transaction_completed_at, status FROM {_t}"
    )
ORACLE["list_input_files"] = build(_union([f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS n_rows FROM {t}" for t in RAW]))
ORACLE["stream_ingest_all"] = build(_union(
    [f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS n_rows, CAST(SUM({k}) AS DECIMAL(38,0)) AS key_sum FROM {t}" for t, k in TABLE_KEYS.items()]
))
ORACLE["stream_unified_transactions"] = model("int_unified_transactions")
ORACLE["materialize_roundtrip"] = model("fct_account_monthly_balances")
for _m in [
    "stg_accounts", "stg_customers", "stg_pix_movements", "stg_transfer_ins", "stg_transfer_outs",
    "base_location_hierarchy", "base_time_dimension", "int_unified_transactions", "int_transactions_enriched",
    "int_account_monthly_spine", "int_monthly_transaction_summary", "int_transactions_summary",
    "int_transactions_summary_literal", "dim_account", "dim_calendar", "dim_customer", "fct_transactions",
    "fct_transactions_literal", "fct_account_monthly_balances", "report_monthly_business_kpi",
    "kpi_month_over_month", "report_customer_segmentation",
]:
    ORACLE[_m] = model(_m)
ORACLE["date_spine"] = _date_spine()
ORACLE["dq_not_null"] = _not_null()
ORACLE["dq_unique"] = _unique()
ORACLE["dq_accepted_values"] = _accepted_values()
ORACLE["dq_relationships"] = _relationships()
ORACLE["dq_accepted_range"] = _accepted_range()
ORACLE["dq_expression"] = _expression()
ORACLE["dq_row_count"] = _row_count()
ORACLE["dq_duplicate_transactions"] = build(
    "SELECT transaction_id, COUNT(*) AS occurrence_count FROM int_unified_transactions GROUP BY transaction_id HAVING COUNT(*) > 1"
)
ORACLE["dq_orphan_transactions"] = build(
    "SELECT account_id, n AS orphaned_transactions FROM (SELECT account_id, COUNT(*) AS n FROM int_unified_transactions GROUP BY ALL) "
    "WHERE account_id IS NULL OR account_id NOT IN (SELECT account_id FROM stg_accounts)"
)
ORACLE["dq_missing_dates"] = _missing_dates()
ORACLE["dq_calendar_unique_per_date"] = build(
    "SELECT utc_date, COUNT(*) AS rows_per_date FROM base_time_dimension GROUP BY utc_date HAVING COUNT(*) > 1"
)
ORACLE["dq_non_empty"] = _non_empty()

for _m in ("dim_account", "int_monthly_transaction_summary"):
    ORACLE[f"bucketed_{_m}"] = ORACLE[_m]
ORACLE["bucketed_orphan_transactions"] = ORACLE["dq_orphan_transactions"]
ORACLE["kpi_distinct_accounts"] = build(
    "SELECT month_date AS report_month, year, month, COUNT(DISTINCT account_id) AS total_active_accounts, "
    "COUNT(DISTINCT account_id) FILTER (WHERE has_activity) AS active_accounts, "
    "COUNT(DISTINCT account_id) FILTER (WHERE is_high_activity) AS high_activity_accounts "
    "FROM fct_account_monthly_balances WHERE month_date IS NOT NULL GROUP BY ALL"
)


# --- fixed values: freshness classes and limits in hours ---
FRESH = [("pix_movements", "high_frequency", 4), ("transfer_ins", "high_frequency", 4), ("transfer_outs", "high_frequency", 4),
         ("accounts", "medium_frequency", 24), ("customers", "medium_frequency", 24)]
_SEEN = {"pix_movements": "pix_requested_at", "transfer_ins": parse_ts("transaction_requested_at"),
         "transfer_outs": parse_ts("transaction_requested_at"), "accounts": "created_at", "customers": "CAST(NULL AS TIMESTAMP)"}
_EACH = _union([
    f"SELECT '{t}' AS table_name, '{c}' AS category, (SELECT max({_SEEN[t]}) FROM {t}) AS last_seen, CAST({h} AS INTEGER) AS limit_hours" for t, c, h in FRESH
])
_FRESH = f"SELECT *, coalesce(max(last_seen) OVER () - last_seen < limit_hours * INTERVAL 1 HOUR, FALSE) AS is_fresh FROM ({_EACH})"
_FRESH = f"SELECT *, if(is_fresh, 'ok', if(category = 'high_frequency', 'critical', 'warning')) AS severity FROM ({_FRESH})"
ORACLE["dq_freshness"] = build(_FRESH)
_LOOKUPS = _union([f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in ["city", "country", "state", "d_time", "d_month", "d_week", "d_weekday", "d_year"]])
ORACLE["dq_validation_summary"] = build(f"""
SELECT category, count(*) AS checked_count, count(*) FILTER (good) AS passed_count, count(*) FILTER (NOT good) AS missing_count,
       coalesce(string_agg(table_name, ',' ORDER BY table_name) FILTER (NOT good), '') AS missing_tables,
       if(bool_or(severity = 'critical'), 'critical', if(bool_and(good), 'ok', 'warning')) AS severity,
       bool_or(bool_or(severity = 'critical')) OVER () AS pipeline_fails
FROM (SELECT category, table_name, is_fresh AS good, severity FROM ({_FRESH})
      UNION ALL
      SELECT 'low_frequency', table_name, n > 0, if(n > 0, 'ok', 'warning') FROM ({_LOOKUPS}))
GROUP BY category""")
