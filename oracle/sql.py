"""Independent DuckDB SQL for every compared query.

The adapter is written again as plain SQL CTEs over the driver views (customer,
orders, lineitem, nation, region). The models are computed another way than in
Spark, from what the survey says they mean: calendar attributes straight from the
date instead of through lookups, bands by counting the bounds that a value has
passed, the account-month grid by generating each account's own months, and
summaries by stacking grid rows and transactions before one aggregation.
Only the rounding is shared: exact half-up integer arithmetic on both sides.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2001-12-31'"
DEFAULT_START = "DATE '1995-01-01'"


# -- helpers -----------------------------------------------------------------------

def div_half_up(num: str, den: str, scale: int, num_scale: int = 0, den_scale: int = 0, times: int = 1) -> str:
    """SQL for round(times * num / den, scale), half away from zero, as DECIMAL(38, scale)."""
    n = f"CAST(({num}) * {10 ** num_scale} AS HUGEINT)" if num_scale else f"CAST(({num}) AS HUGEINT)"
    d = f"CAST(({den}) * {10 ** den_scale} AS HUGEINT)" if den_scale else f"CAST(({den}) AS HUGEINT)"
    shift = scale + den_scale - num_scale
    a = f"(abs({n}) * CAST({times * 10 ** max(shift, 0)} AS HUGEINT))"
    b = f"(abs({d}) * CAST({10 ** max(-shift, 0)} AS HUGEINT))"
    q = f"((2 * {a} + {b}) // (2 * {b}))"
    signed = f"(CASE WHEN ({n} < 0) <> ({d} < 0) THEN -{q} ELSE {q} END)"
    unit = "1" if scale == 0 else "0." + "0" * (scale - 1) + "1"
    return f"CAST(CAST({signed} AS DECIMAL(38,0)) * CAST('{unit}' AS DECIMAL({scale + 1},{scale})) AS DECIMAL(38,{scale}))"


def avg6(x: str) -> str:
    """AVG of a DECIMAL(18,2) the way Spark types it: DECIMAL(22,6), half-up."""
    return f"CAST(CASE WHEN COUNT({x}) > 0 THEN {div_half_up(f'SUM({x})', f'COUNT({x})', 6, num_scale=2)} END AS DECIMAL(22,6))"


def parse_ts(x: str) -> str:
    """Epoch-second text or ISO text -> TIMESTAMP (NULL when neither)."""
    return (
        f"COALESCE(make_timestamp(TRY_CAST(trim({x}) AS BIGINT) * 1000000), TRY_CAST(trim({x}) AS TIMESTAMP))"
    )


def epoch_text(x: str) -> str:
    return f"CAST(CAST(epoch({x}) AS BIGINT) AS VARCHAR)"


def sum28(x: str) -> str:
    return f"CAST(SUM({x}) AS DECIMAL(28,2))"


# -- CTE bodies (dependency order) ---------------------------------------------------

CTES: dict[str, str] = {}

# adapter: driver tables -> raw bank tables
CTES["accounts"] = """
SELECT CASE WHEN c_custkey % 50 = 49 THEN c_custkey + 1000000000000 ELSE c_custkey END AS account_id, c_name AS account_name,
       CAST(DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS TIMESTAMP) AS created_at,
       CASE WHEN c_custkey % 10 = 3 THEN 'inactive' ELSE 'active' END AS status
FROM customer"""

CTES["customers"] = """
SELECT c_custkey AS customer_id,
       CASE WHEN c_custkey % 11 = 5 THEN NULL ELSE c_mktsegment END AS first_name,
       CASE c_custkey % 3 WHEN 0 THEN substr(c_name, 1, 4) WHEN 1 THEN c_name ELSE c_name || c_mktsegment END AS last_name,
       CASE WHEN c_custkey % 7 = 2 THEN NULL ELSE CAST(c_nationkey AS BIGINT) END AS customer_city,
       CAST(CASE WHEN c_custkey % 13 = 4 THEN NULL WHEN c_custkey % 5 = 0 THEN 900000000 + c_custkey
                 ELSE 10000000000 + c_custkey END AS BIGINT) AS cpf,
       CASE c_custkey % 4 WHEN 0 THEN ' Brazil ' WHEN 1 THEN 'Brasil' WHEN 2 THEN 'Mexico' END AS country_name
FROM customer"""

CTES["pix_movements"] = """
SELECT o_orderkey AS id, CASE WHEN o_custkey % 50 = 7 THEN o_custkey + 2000000000000 ELSE o_custkey END AS account_id,
       CAST(CASE o_orderkey % 23 WHEN 1 THEN CAST(50.00 AS DECIMAL(18,2)) WHEN 2 THEN CAST(0 AS DECIMAL(18,2))
                 WHEN 3 THEN CAST(1500000 AS DECIMAL(18,2)) ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS pix_amount,
       CAST(o_orderdate AS TIMESTAMP) AS pix_requested_at,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS TIMESTAMP) END AS pix_completed_at,
       CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'completed' END AS status,
       CASE WHEN o_orderkey % 17 = 0 THEN 'pix_other' WHEN o_orderkey % 2 = 0 THEN 'pix_in' ELSE ' PIX_OUT ' END AS in_or_out
FROM orders"""

CTES["lines_fed"] = f"""
SELECT l_orderkey * 10 + l_linenumber AS id,
       o_custkey + CASE WHEN o_custkey % 50 = 7 THEN 2000000000000 ELSE 0 END AS account_id,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
       {epoch_text('o_orderdate')} AS transaction_requested_at,
       CASE l_linestatus WHEN 'F' THEN {epoch_text('l_shipdate')} ELSE 'None' END AS transaction_completed_at,
       CASE l_linestatus WHEN 'F' THEN 'completed' ELSE 'pending' END AS status,
       if(l_returnflag IN ('A', 'R'), if(l_returnflag = 'A', 'in', 'out'), if(l_linenumber % 2 = 0, 'in', 'out')) AS feed
FROM lineitem, orders WHERE o_orderkey = l_orderkey"""

for _feed in ("in", "out"):
    CTES[f"transfer_{_feed}s"] = f"SELECT * EXCLUDE (feed) FROM lines_fed WHERE feed = '{_feed}'"

CTES["city"] = """
SELECT n_name AS city_name, CAST(CASE WHEN n_nationkey = 24 THEN 99 ELSE n_regionkey END AS BIGINT) AS state_id,
       CAST(n_nationkey AS BIGINT) AS city_id
FROM nation"""

CTES["state"] = """
SELECT r_name AS state, CAST(r_regionkey + 1 AS INTEGER) AS country_id, CAST(r_regionkey AS INTEGER) AS state_id
FROM region"""

CTES["country"] = """
SELECT CASE WHEN r_regionkey + 1 <= 5 THEN ['Brazil', 'Argentina', 'Mexico', 'Colombia', 'Chile'][r_regionkey + 1] END AS country,
       CAST(r_regionkey + 1 AS BIGINT) AS country_id
FROM region"""

CTES["cal_bounds"] = """
SELECT min(d) AS lo, max(d) AS hi
FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem)"""

CTES["cal_days"] = """
SELECT CAST(unnest(generate_series(CAST(date_trunc('year', lo) AS DATE), make_date(year(hi), 12, 31), INTERVAL 1 DAY)) AS DATE) AS d
FROM cal_bounds"""

CTES["d_time"] = """
SELECT CAST(strftime(d, '%Y%m%d') || CASE h WHEN 12 THEN '12' ELSE '' END AS BIGINT) AS time_id,
       strftime(d, '%Y-%m-%d') || CASE h WHEN 12 THEN ' 12:00:00' ELSE ' 00:00:00' END AS action_timestamp,
       CAST(weekofyear(d) AS INTEGER) AS week_id, CAST(month(d) AS INTEGER) AS month_id,
       CAST(year(d) AS INTEGER) AS year_id, CAST(isodow(d) AS INTEGER) AS weekday_id
FROM (SELECT d, unnest(CASE WHEN (d - DATE '1970-01-01') % 61 = 7 THEN [0, 12] ELSE [0] END) AS h
      FROM cal_days WHERE (d - DATE '1970-01-01') % 97 <> 13)
UNION ALL
SELECT CAST(-1 AS BIGINT), 'None', 1, 1, CAST(year(lo) AS INTEGER), 1 FROM cal_bounds"""

CTES["d_week"] = "SELECT DISTINCT CAST(weekofyear(d) AS INTEGER) AS week_id, CAST(weekofyear(d) AS INTEGER) AS action_week FROM cal_days"
CTES["d_month"] = "SELECT DISTINCT CAST(month(d) AS INTEGER) AS month_id, CAST(month(d) AS BIGINT) AS action_month FROM cal_days"
CTES["d_year"] = "SELECT DISTINCT CAST(year(d) AS INTEGER) AS year_id, CAST(year(d) AS INTEGER) AS action_year FROM cal_days"
CTES["d_weekday"] = "SELECT DISTINCT CAST(isodow(d) AS INTEGER) AS weekday_id, dayname(d) AS action_weekday FROM cal_days"

# staging
CTES["stg_accounts"] = """
SELECT account_id, account_name, created_at AS account_created_at, status AS account_status, 'accounts' AS source_table
FROM accounts WHERE account_id IS NOT NULL"""

CTES["stg_customers"] = """
SELECT customer_id, first_name, last_name, customer_city, cpf, country_name, 'customers' AS source_table
FROM customers WHERE customer_id IS NOT NULL"""

CTES["stg_pix_movements"] = """
SELECT id AS transaction_id, account_id, pix_amount AS transaction_amount,
       pix_requested_at AS transaction_requested_at, pix_completed_at AS transaction_completed_at,
       CAST(year(pix_completed_at) AS INTEGER) AS completed_year, CAST(month(pix_completed_at) AS INTEGER) AS completed_month,
       status, in_or_out AS transaction_type, lower(trim(status)) AS transaction_status,
       CASE WHEN lower(trim(in_or_out)) = 'pix_in' THEN 'in' WHEN lower(trim(in_or_out)) = 'pix_out' THEN 'out'
            ELSE 'unknown' END AS transaction_direction,
       'pix_movements' AS source_table
FROM pix_movements WHERE status = 'completed'"""


def _stg_transfer(table: str, direction: str) -> str:
    done = parse_ts("transaction_completed_at")
    return f"""
SELECT id AS transaction_id, account_id, amount AS transaction_amount,
       {parse_ts('transaction_requested_at')} AS transaction_requested_at,
       {done} AS transaction_completed_at,
       CAST(year({done}) AS INTEGER) AS completed_year, CAST(month({done}) AS INTEGER) AS completed_month,
       lower(trim(status)) AS transaction_status, '{direction}' AS transaction_direction, '{table}' AS source_table
FROM {table} WHERE status = 'completed'"""


CTES["stg_transfer_ins"] = _stg_transfer("transfer_ins", "in")
CTES["stg_transfer_outs"] = _stg_transfer("transfer_outs", "out")

# --- helpers of the models ---

def band(value: str, bounds: list[int], names: list[str], inclusive: bool = False) -> str:
    """The name after as many bounds as ``value`` has passed (inclusive: a bound itself is not passed)."""
    passed = " + ".join(f"CAST({value} {'>' if inclusive else '>='} {b} AS INTEGER)" for b in bounds)
    listed = ", ".join(f"'{n}'" for n in names)
    return f"([{listed}])[1 + {passed}]"


def yes(condition: str) -> str:
    """A condition as a flag that is never NULL."""
    return f"coalesce({condition}, FALSE)"


def pct(part: str, whole: str) -> str:
    return div_half_up(part, whole, 2, times=100)


CTES["base_location_hierarchy"] = """
SELECT CAST(n_nationkey AS BIGINT) AS location_id, n_name AS city,
       CAST(if(n_nationkey = 24, 99, n_regionkey) AS BIGINT) AS state_id,
       r_name AS state, CAST(r_regionkey + 1 AS INTEGER) AS country_id,
       place.names[r_regionkey + 1] AS country, place.codes[r_regionkey + 1] AS country_iso2,
       place.names[r_regionkey + 1] || ' > ' || r_name || ' > ' || n_name AS full_location_path
FROM (SELECT ['Brazil', 'Argentina', 'Mexico', 'Colombia', 'Chile'] AS names, ['BR', 'AR', 'MX', 'CO', NULL] AS codes) place
CROSS JOIN nation LEFT JOIN region ON n_nationkey <> 24 AND r_regionkey = n_regionkey"""

CTES["cal_stamps"] = f"""
SELECT time_id, week_id, month_id, year_id, weekday_id, ts, CAST(ts AS DATE) AS day
FROM (SELECT *, {parse_ts('action_timestamp')} AS ts FROM d_time) WHERE ts IS NOT NULL AND time_id IS NOT NULL"""

CTES["base_time_dimension"] = """
SELECT time_id, week_id, month_id, year_id, weekday_id,
       dayname(day) AS weekday_name, monthname(day) AS month_name, 'Q' || quarter(day) AS quarter_name,
       (['week_start', 'weekday', 'weekday', 'weekday', 'week_end', 'weekend', 'weekend'])[isodow(day)] AS business_day_type,
       CAST(weekofyear(day) AS INTEGER) AS week_number, CAST(month(day) AS BIGINT) AS month_number, CAST(year(day) AS INTEGER) AS year_number,
       CAST(quarter(day) AS INTEGER) AS quarter_number, CAST(dayofmonth(day) AS INTEGER) AS day_of_month,
       CAST(dayofyear(day) AS INTEGER) AS day_of_year, CAST(weekofyear(day) AS INTEGER) AS week_of_year,
       CAST(year(day) AS INTEGER) AS fiscal_year,
       strftime(day, '%Y-%m') AS year_month, year(day) || '-Q' || quarter(day) AS year_quarter,
       year(day) || '-W' || right('0' || weekofyear(day), 2) AS year_week,
       ts AS utc_timestamp, day AS utc_date,
       day - CAST(dayofmonth(day) - 1 AS INTEGER) AS month_start_date, day - CAST(isodow(day) - 1 AS INTEGER) AS week_start_date,
       make_date(year(day), 1, 1) AS year_start_date, make_date(year(day), 3 * quarter(day) - 2, 1) AS quarter_start_date,
       isodow(day) < 6 AS is_weekday, month(day) % 12 < 3 AS is_summer_brazil, month(day) BETWEEN 6 AND 8 AS is_winter_brazil,
       dayofmonth(day) = 1 AS is_month_start, dayofmonth(day + 1) = 1 AS is_month_end
FROM cal_stamps"""

CTES["int_unified_transactions"] = """
SELECT transaction_id, account_id, transaction_amount, transaction_requested_at, transaction_completed_at, transaction_status,
       transaction_direction, if(source_table = 'pix_movements', 'PIX', 'TRANSFER') AS transaction_channel,
       if(transaction_direction = 'unknown', NULL, if(source_table = 'pix_movements', 'PIX_', 'TRANSFER_') || upper(transaction_direction)) AS transaction_type,
       source_table
FROM (SELECT * FROM stg_pix_movements UNION ALL BY NAME SELECT * FROM stg_transfer_ins UNION ALL BY NAME SELECT * FROM stg_transfer_outs)"""

_SIZES = band("transaction_amount", [100, 1000, 10000, 100000], ["micro", "small", "medium", "large", "enterprise"])
CTES["day_stamps"] = "SELECT day, count(*) AS stamps FROM cal_stamps GROUP BY day"
CTES["int_transactions_enriched"] = f"""
SELECT transaction_id, account_id, transaction_channel, transaction_direction, source_table,
       CAST(year(day) AS INTEGER) AS completed_year, CAST(month(day) AS BIGINT) AS completed_month_number,
       CAST(weekofyear(day) AS INTEGER) AS completed_week, dayname(day) AS completed_weekday,
       CAST(quarter(day) AS INTEGER) AS completed_quarter, transaction_amount,
       CAST(transaction_amount * (CAST(transaction_direction = 'in' AS INTEGER) - CAST(transaction_direction = 'out' AS INTEGER)) AS DECIMAL(18,2)) AS signed_amount,
       transaction_completed_at, day AS completed_date, make_date(year(day), month(day), 1) AS completed_month_date,
       {yes('transaction_amount >= 1000')} AS is_large_transaction, 'BRL' AS currency_code,
       coalesce({_SIZES}, 'enterprise') AS transaction_size_category
FROM (SELECT u.*, k.day, unnest(range(coalesce(k.stamps, 1)))
      FROM int_unified_transactions u LEFT JOIN day_stamps k ON k.day = CAST(u.transaction_completed_at AS DATE)
      WHERE u.transaction_completed_at IS NOT NULL)"""

CTES["own_range"] = """
SELECT account_id, CAST(date_trunc('month', min(transaction_completed_at)) AS DATE) AS lo, CAST(date_trunc('month', max(transaction_completed_at)) AS DATE) AS hi
FROM int_unified_transactions WHERE transaction_status = 'completed' GROUP BY account_id"""

CTES["int_account_monthly_spine"] = f"""
SELECT account_id, CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS BIGINT) AS month, m AS month_date
FROM (SELECT account_id, CAST(unnest(generate_series(coalesce(lo, {DEFAULT_START}), coalesce(hi, {AS_OF}), INTERVAL 1 MONTH)) AS DATE) AS m
      FROM (SELECT account_id FROM stg_accounts GROUP BY account_id HAVING bool_or(account_status = 'active'))
      LEFT JOIN own_range USING (account_id))
WHERE m IN (SELECT month_start_date FROM base_time_dimension)"""


def _stacked(month: str) -> str:
    """Grid rows (no transaction) above the transactions that fall on the grid."""
    return f"""
SELECT account_id, month_date, year, month, NULL AS transaction_id, NULL AS way, NULL AS channel, NULL AS size, NULL AS amount, NULL AS flow, 0 AS hit
FROM int_account_monthly_spine
UNION ALL
SELECT account_id, month_date, year, month, transaction_id, transaction_direction, transaction_channel, transaction_size_category, transaction_amount, signed_amount, 1
FROM int_account_monthly_spine JOIN (SELECT *, {month} AS month_date FROM int_transactions_enriched) USING (account_id, month_date)"""


def _money(x: str, when: str = "TRUE") -> str:
    return f"CAST(coalesce(sum({x}) FILTER ({when}), 0) AS DECIMAL(28,2))"


def _summed(label_in: str, label_out: str) -> str:
    inbound, outbound = f"way = '{label_in}'", f"way = '{label_out}'"
    return f"""{_money('amount', inbound)} AS inbound_volume, {_money('amount', outbound)} AS outbound_volume,
       {_money('flow')} AS net_flow, count(*) FILTER ({inbound}) AS inbound_transactions, count(*) FILTER ({outbound}) AS outbound_transactions,
       {_money('flow', "channel = 'PIX'")} AS pix_net_flow, {_money('flow', "channel = 'TRANSFER'")} AS transfer_net_flow,
       count(*) FILTER (channel = 'PIX') AS pix_transactions, count(*) FILTER (channel = 'TRANSFER') AS transfer_transactions"""


CTES["month_rows"] = _stacked("CAST(date_trunc('month', transaction_completed_at) AS DATE)")
CTES["int_monthly_transaction_summary"] = f"""
SELECT account_id, year, month, month_date, {_summed('in', 'out')},
       CAST(sum(hit) AS BIGINT) AS total_transactions, sum(hit) > 0 AS has_activity,
       {avg6("CASE way WHEN 'in' THEN amount END")} AS avg_inbound_transaction_amount,
       {avg6("CASE way WHEN 'out' THEN amount END")} AS avg_outbound_transaction_amount
FROM month_rows GROUP BY account_id, year, month, month_date"""

CTES["calendar_month_rows"] = _stacked("completed_month_date")
for _name, _in, _out in (("int_transactions_summary", "in", "out"), ("int_transactions_summary_literal", "TRANSFER_IN", "TRANSFER_out")):
    _classes = ", ".join(f"count(*) FILTER (size = '{k}') AS {k}_transactions" for k in ("micro", "small", "medium", "large"))
    _inbound, _outbound = (f"CASE way WHEN '{x}' THEN amount END" for x in (_in, _out))
    CTES[_name] = f"""
SELECT account_id, month_date, year, month, {_summed(_in, _out)}, count(transaction_id) AS total_transactions, {_classes},
       {avg6(_inbound)} AS avg_inbound_amount, {avg6(_outbound)} AS avg_outbound_amount
FROM calendar_month_rows GROUP BY account_id, month_date, year, month"""

CTES["lifetime"] = """
SELECT account_id, list_min(list(transaction_completed_at)) AS first_transaction_date, list_max(list(transaction_completed_at)) AS last_transaction_date,
       len(list(transaction_completed_at)) AS n, CAST(sum(transaction_amount) AS DECIMAL(28,2)) AS volume,
       len(list_distinct(list(CAST(transaction_completed_at AS DATE)))) AS days
FROM int_transactions_enriched GROUP BY account_id"""

_AGES = band("age", [30, 90, 365], ["New (< 30 days)", "Recent (30-90 days)", "Established (3-12 months)", "Mature (> 1 year)"])
_BUSY = band("txns", [0, 10, 50], ["Inactive", "Low Activity", "Medium Activity", "High Activity"], inclusive=True)
_TIERS = band("money", [1000, 10000, 100000], ["Low Value", "Medium Value", "High Value", "Premium Value"])
CTES["dim_account"] = f"""
SELECT account_id, account_name, account_status, account_created_at, first_transaction_date, last_transaction_date,
       txns AS total_lifetime_transactions, money AS total_lifetime_volume, CAST(coalesce(days, 0) AS BIGINT) AS active_days,
       age AS account_age_days, {_AGES} AS account_age_segment, {_BUSY} AS activity_segment,
       if(money = 0, 'No Value', {_TIERS}) AS value_tier, {yes("account_status = 'active'")} AS is_active,
       n IS NOT NULL AS has_transactions, {yes(f"CAST(last_transaction_date AS DATE) >= {AS_OF} - 30")} AS is_recently_active,
       {yes('age <= 30')} AS is_new_account, source_table
FROM (SELECT *, CAST({AS_OF} - CAST(account_created_at AS DATE) AS INTEGER) AS age, CAST(coalesce(n, 0) AS BIGINT) AS txns,
             CAST(coalesce(volume, 0) AS DECIMAL(28,2)) AS money
      FROM stg_accounts LEFT JOIN lifetime USING (account_id))"""

CTES["dim_calendar"] = """
SELECT time_id, ts AS utc_timestamp, day AS utc_date, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS BIGINT) AS month,
       CAST(weekofyear(day) AS INTEGER) AS week, dayname(day) AS weekday, CAST(quarter(day) AS INTEGER) AS quarter,
       make_date(year(day), month(day), 1) AS month_start_date, day - CAST(isodow(day) - 1 AS INTEGER) AS week_start_date,
       isodow(day) < 6 AS is_weekday,
       (['Summer', 'Autumn', 'Winter', 'Spring'])[1 + (month(day) % 12) // 3] AS season_southern_hemisphere
FROM cal_stamps"""

_NAMES = band("(length(first_name) + length(last_name))", [15, 30], ["Short Name", "Medium Name", "Long Name"], inclusive=True)
CTES["dim_customer"] = f"""
SELECT customer_id, cpf, first_name, last_name, first_name || ' ' || last_name AS full_name, customer_city, country_name,
       coalesce({_NAMES}, 'Short Name') AS name_length_category, upper(trim(CAST(customer_city AS VARCHAR))) AS city_normalized,
       upper(trim(country_name)) AS country_normalized, (first_name || last_name) IS NOT NULL AS has_complete_name,
       customer_city IS NOT NULL AS has_city_info, {yes("regexp_full_match(CAST(cpf AS VARCHAR), '.{11}')")} AS has_valid_cpf, source_table
FROM stg_customers"""


def _portion(condition: str) -> str:
    return f"CAST(transaction_amount * CAST({yes(condition)} AS INTEGER) AS DECIMAL(18,2))"


for _name, _in, _out in (("fct_transactions", "in", "out"), ("fct_transactions_literal", "TRANSFER_IN", "TRANSFER_OUT")):
    CTES[_name] = f"""
SELECT *, {_portion(f"transaction_direction = '{_in}'")} AS inbound_amount, {_portion(f"transaction_direction = '{_out}'")} AS outbound_amount,
       {_portion("transaction_channel = 'PIX'")} AS pix_amount, {_portion("transaction_channel = 'TRANSFER'")} AS transfer_amount
FROM int_transactions_enriched WHERE transaction_amount > 0 AND transaction_id + account_id IS NOT NULL"""

_LEVELS = band("total_transactions", [0, 5, 20], ["No Activity", "Low Activity", "Medium Activity", "High Activity"], inclusive=True)
CTES["fct_account_monthly_balances"] = f"""
SELECT *, inbound_volume > outbound_volume AS is_net_positive, total_transactions > 9 AS is_high_activity,
       pix_transactions > transfer_transactions AS prefers_pix,
       if(outbound_volume > 0, {div_half_up('inbound_volume', 'outbound_volume', 2, 2, 2)}, NULL) AS inbound_outbound_ratio,
       {_LEVELS} AS activity_level,
       if(pix_transactions + transfer_transactions = 0, 'No Activity',
          (['Transfer Preferred', 'Mixed Usage', 'PIX Preferred'])[2 + CAST(sign(pix_transactions - transfer_transactions) AS INTEGER)]) AS channel_preference
FROM int_monthly_transaction_summary WHERE account_id IS NOT NULL"""

CTES["month_accounts"] = """
SELECT month_date, year, month, account_id, bool_or(has_activity) AS acts, bool_or(is_high_activity) AS rushes
FROM fct_account_monthly_balances GROUP BY month_date, year, month, account_id"""
CTES["month_heads"] = """
SELECT month_date, year, month, count(*) AS heads, count(*) FILTER (acts) AS acting, count(*) FILTER (rushes) AS rushing
FROM month_accounts GROUP BY month_date, year, month"""


def _mean(x: str) -> str:
    exact = div_half_up(f"sum({x})", f"count({x})", 10, 6)
    return f"CAST(round(CASE WHEN count({x}) > 0 THEN {exact} END, 2) AS DECIMAL(38,2))"


_BIG = {"total_inbound_volume": "inbound_volume", "total_outbound_volume": "outbound_volume", "total_net_flow": "net_flow",
        "total_pix_flow": "pix_net_flow", "total_transfer_flow": "transfer_net_flow"}
_COUNTS = {"total_transactions": "total_transactions", "total_pix_transactions": "pix_transactions", "total_transfer_transactions": "transfer_transactions"}
CTES["month_money"] = f"""
SELECT month_date, year, month, {", ".join(f"CAST(sum({c}) AS DECIMAL(38,2)) AS {n}" for n, c in _BIG.items())},
       {", ".join(f"CAST(sum({c}) AS BIGINT) AS {n}" for n, c in _COUNTS.items())},
       {_mean('avg_inbound_transaction_amount')} AS avg_inbound_amount, {_mean('avg_outbound_transaction_amount')} AS avg_outbound_amount
FROM fct_account_monthly_balances GROUP BY month_date, year, month"""

_ZERO = "CAST(0 AS DECIMAL(38,2))"
CTES["report_monthly_business_kpi"] = f"""
SELECT month_date AS report_month, year, month, heads AS total_active_accounts, acting AS active_accounts, rushing AS high_activity_accounts,
       {pct('acting', 'heads')} AS account_activation_rate_pct,
       * EXCLUDE (month_date, year, month, heads, acting, rushing),
       if(total_outbound_volume > 0, {div_half_up('total_inbound_volume', 'total_outbound_volume', 2, 2, 2)}, NULL) AS inflow_outflow_ratio,
       if(total_transactions > 0, {pct('total_pix_transactions', 'total_transactions')}, {_ZERO}) AS pix_adoption_rate_pct,
       if(total_pix_flow + total_transfer_flow = 0, {_ZERO},
          {div_half_up('total_pix_flow', 'total_pix_flow + total_transfer_flow', 2, 2, 2, times=100)}) AS pix_volume_share_pct,
       any_value(total_inbound_volume) OVER earlier AS prev_month_inbound_volume, any_value(total_transactions) OVER earlier AS prev_month_transactions
FROM month_money JOIN month_heads USING (month_date, year, month)
WINDOW earlier AS (ORDER BY month_date, year, month ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING)"""

CTES["kpi_month_over_month"] = """
SELECT report_month, total_inbound_volume, prev_month_inbound_volume, total_transactions, prev_month_transactions
FROM report_monthly_business_kpi"""

# --- fixed values: first-tier cities and domestic country names ---
_TIER1 = ["SÃO PAULO", "SAO PAULO", "RIO DE JANEIRO", "BRASÍLIA", "BRASILIA", "BELO HORIZONTE", "SALVADOR", "FORTALEZA", "RECIFE", "PORTO ALEGRE"]
_HOME = ["BRAZIL", "BRASIL"]
CTES["graded_customers"] = f"""
SELECT *, CASE grade WHEN 3 THEN if(home, 'Premium Domestic', 'Premium International') WHEN 2 THEN 'Standard Customer'
                     WHEN 1 THEN 'Basic Customer' ELSE 'Incomplete Customer' END AS customer_segment,
       (['Incomplete Profile', 'Minimal Profile - CPF Only', 'Partial Profile - Missing Location', 'Complete Profile'])[1 + grade] AS profile_completeness_segment,
       if(country_normalized IS NULL, 'Unknown Location', if(home, 'Domestic', 'International')) AS geographic_segment,
       if(customer_city IS NULL, 'Unknown City', if(list_contains({_TIER1!r}, upper(CAST(customer_city AS VARCHAR))), 'Tier 1 City', 'Other City')) AS city_tier
FROM (SELECT *, if(has_valid_cpf, 1 + CAST(has_complete_name AS INTEGER) + CAST(has_complete_name AND has_city_info AS INTEGER), 0) AS grade,
             {yes(f"list_contains({_HOME!r}, country_normalized)")} AS home
      FROM dim_customer)"""

CTES["report_customer_segmentation"] = f"""
SELECT customer_segment, geographic_segment, profile_completeness_segment, name_length_category, city_tier, n AS customers_count,
       named AS customers_with_complete_name, placed AS customers_with_city, valid AS customers_with_valid_cpf,
       if(geographic_segment = 'Domestic', n, 0) AS domestic_customers, if(geographic_segment = 'International', n, 0) AS international_customers,
       if(profile_completeness_segment = 'Complete Profile', n, 0) AS complete_profile_customers,
       if(contains(profile_completeness_segment, 'Partial'), n, 0) AS partial_profile_customers,
       if(name_length_category = 'Long Name', n, 0) AS long_name_customers, if(name_length_category = 'Medium Name', n, 0) AS medium_name_customers,
       if(name_length_category = 'Short Name', n, 0) AS short_name_customers,
       {pct('n', '(SELECT count(*) FROM dim_customer)')} AS segment_percentage, {pct('valid', 'n')} AS cpf_completion_rate,
       {pct('named', 'n')} AS name_completion_rate, {pct('placed', 'n')} AS city_completion_rate
FROM (SELECT customer_segment, geographic_segment, profile_completeness_segment, name_length_category, city_tier, count(*) AS n,
             count(*) FILTER (has_complete_name) AS named, count(*) FILTER (has_city_info) AS placed, count(*) FILTER (has_valid_cpf) AS valid
      FROM graded_customers
      GROUP BY customer_segment, geographic_segment, profile_completeness_segment, name_length_category, city_tier)"""


# -- composition ---------------------------------------------------------------------

def _deps(body: str, names: list[str]) -> list[str]:
    return [n for n in names if re.search(rf"\b{re.escape(n)}\b", body)]


def build(select: str, extra: dict[str, str] | None = None) -> str:
    """``WITH <needed CTEs> <select>``; CTEs are pulled in by name, in dependency order."""
    ctes = dict(CTES)
    if extra:
        ctes.update(extra)
    names = list(ctes)
    needed: set[str] = set()
    stack = _deps(select, names)
    while stack:
        n = stack.pop()
        if n in needed:
            continue
        needed.add(n)
        stack.extend(d for d in _deps(ctes[n], names) if d != n)
    ordered = [n for n in names if n in needed]
    if not ordered:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({ctes[n]})" for n in ordered) + "\n" + select


def model(name: str) -> str:
    return build(f"SELECT * FROM {name}")
