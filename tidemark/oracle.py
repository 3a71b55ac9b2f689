"""SQL equivalents of the registered queries, for an independent engine on the same tables."""

from __future__ import annotations

from tidemark.config import DQ_THRESHOLDS, LABEL_CAVEAT, PII_COLUMNS
from tidemark.plans.roles import TODAY

_DAY = "'%Y-%m-%d'"
_SECOND = "'%Y-%m-%d %H:%M:%S'"
_MICRO = "'%Y-%m-%d %H:%M:%S.%f'"


def day(c: str) -> str:
    return f"strftime({c}, {_DAY})"


def micro(c: str) -> str:
    return f"strftime(CAST({c} AS TIMESTAMP), {_MICRO})"


def big(c: str) -> str:
    return f"CAST({c} AS BIGINT)"


# The dataset roles as common table expressions.
ROLES = {
    "customers": """
        SELECT c_custkey AS customer_id, c_name AS full_name,
          DATE '1900-01-01' + CAST(c_custkey * 37 % 38000 AS INTEGER) AS dob,
          DATE '1995-01-01' + CAST(c_custkey * 53 % 1500 AS INTEGER) AS signup_date,
          c_mktsegment AS segment,
          CASE WHEN c_acctbal < 0 THEN 'high' WHEN c_acctbal < 5000 THEN 'medium' ELSE 'low' END AS risk_band,
          'street ' || c_nationkey AS address,
          CASE c_custkey % 3 WHEN 0 THEN 'verified' WHEN 1 THEN 'pending' ELSE 'rejected' END AS kyc_status,
          CAST(DATE '1995-01-01' + CAST(c_custkey * 53 % 1500 + c_custkey * 17 % 700 AS INTEGER) AS TIMESTAMP)
            AS last_updated_ts,
          c_nationkey AS nation_key, c_acctbal AS balance
        FROM customer""",
    "customers_incomplete": "SELECT * FROM customers WHERE customer_id % 10 <> 0",
    "merchants": """
        SELECT s_suppkey AS merchant_id, s_name AS merchant_name, s_nationkey AS mcc_code,
          CASE WHEN s_acctbal < 0 THEN 'debtor' ELSE 'creditor' END AS category,
          'C' || (s_nationkey % 10) AS country,
          DATE '1994-01-01' + CAST(s_suppkey * 11 % 900 AS INTEGER) AS onboarding_date,
          s_acctbal / 100 AS merchant_risk_score
        FROM supplier""",
    "transactions": """
        SELECT o_orderkey AS transaction_id, o_custkey * 10 + o_orderkey % 3 AS card_id,
          CASE WHEN o_orderkey % 503 <> 0 THEN o_custkey END AS customer_id,
          o_orderkey % 10 AS merchant_id, o_orderdate AS txn_timestamp,
          CASE WHEN o_orderkey % 211 = 0 THEN -o_totalprice ELSE o_totalprice END AS amount,
          CASE WHEN o_orderkey % 9 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
          CAST(o_custkey % 25 AS INTEGER) AS mcc_code, o_orderpriority AS channel,
          CASE WHEN o_orderkey % 20 = 0 THEN 'refund' WHEN o_orderkey % 20 = 1 THEN 'withdrawal'
            ELSE 'purchase' END AS txn_type,
          o_orderstatus AS status, 'C' || (o_custkey % 10) AS country,
          o_orderstatus = 'P' AS is_fraud_flag, CAST(o_orderdate AS DATE) AS txn_date
        FROM orders""",
    "landed": f"""
        SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, CAST(customer_id AS VARCHAR) AS customer_id,
          CASE WHEN transaction_id % 109 = 0 THEN 'not a time' ELSE strftime(txn_timestamp, {_SECOND}) END
            AS txn_timestamp,
          CASE WHEN transaction_id % 101 = 0 THEN 'bad' ELSE CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR) END
            AS amount,
          CASE WHEN transaction_id % 113 = 0 THEN 'x12' ELSE CAST(mcc_code AS VARCHAR) END AS mcc_code,
          CASE WHEN transaction_id % 107 = 0 THEN 'maybe' ELSE CAST(is_fraud_flag AS VARCHAR) END AS is_fraud_flag,
          CASE WHEN transaction_id % 103 = 0 THEN '2001-02-30' ELSE strftime(txn_timestamp, {_DAY}) END AS txn_date
        FROM transactions""",
    "parsed": """
        SELECT *, TRY_CAST(txn_timestamp AS TIMESTAMP) AS p_ts, TRY_CAST(amount AS DECIMAL(18,2)) AS p_amount,
          TRY_CAST(mcc_code AS INTEGER) AS p_mcc, TRY_CAST(is_fraud_flag AS BOOLEAN) AS p_fraud,
          TRY_CAST(txn_date AS DATE) AS p_date FROM landed""",
    "customers_landed": f"""
        SELECT CASE WHEN customer_id % 401 <> 0 THEN CAST(customer_id AS VARCHAR) END AS customer_id, full_name,
          CASE WHEN customer_id % 97 = 0 THEN 'unknown' ELSE CAST(dob AS VARCHAR) END AS dob,
          CASE WHEN customer_id % 89 = 0 THEN '31/12/1999' ELSE CAST(signup_date AS VARCHAR) END AS signup_date,
          segment, strftime(last_updated_ts, {_SECOND}) AS last_updated_ts
        FROM customers""",
    "raw_sessions": """
        SELECT event_id AS session_id, user_id AS customer_id, 'dev_' || (user_id % 40) AS device_id, event_type,
          ts AS event_timestamp, value, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
        FROM events""",
    "clean_sessions": """
        SELECT session_id, customer_id, device_id, event_type, event_timestamp,
          '10.0.' || k || '.' || (session_id % 250) AS ip_address,
          CAST(k AS DOUBLE) * 1.8 - 90 AS lat, CAST(k AS DOUBLE) * 3.6 - 180 AS long, 'city_' || (k % 12) AS city,
          CASE WHEN day(event_timestamp) % 3 = 0 THEN value * 10 END AS accuracy_m,
          CASE WHEN k % 2 = 0 THEN 'iOS' ELSE 'Android' END AS os,
          CASE WHEN event_timestamp >= TIMESTAMP '2024-01-05 00:00:00' THEN '4.' || (k % 5) END AS app_version,
          'model_' || (k % 7) AS device_model
        FROM raw_sessions""",
    "sessions": """
        SELECT session_id, customer_id, device_id, event_type, event_timestamp, ip_address,
          session_id % 53 <> 0 AS has_geo, session_id % 59 <> 0 AS has_meta,
          CASE WHEN session_id % 53 = 0 OR session_id % 37 = 0 THEN NULL
            WHEN session_id % 41 = 0 THEN 90.5 ELSE lat END AS lat,
          CASE WHEN session_id % 53 = 0 OR session_id % 43 = 0 THEN NULL
            WHEN session_id % 47 = 0 THEN -200.25 ELSE long END AS long,
          CASE WHEN session_id % 53 <> 0 THEN city END AS city,
          CASE WHEN session_id % 53 <> 0 THEN accuracy_m END AS accuracy_m,
          CASE WHEN session_id % 59 <> 0 THEN os END AS os,
          CASE WHEN session_id % 59 <> 0 THEN app_version END AS app_version,
          CASE WHEN session_id % 59 <> 0 THEN device_model END AS device_model
        FROM clean_sessions""",
    "lines": """
        SELECT l_orderkey AS transaction_id, l_linenumber AS line_no, l_suppkey AS merchant_id,
          CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS amount,
          CAST(l_shipdate AS DATE) AS txn_date, l_returnflag = 'R' AS is_returned
        FROM lineitem""",
    "daily": "SELECT CAST(txn_timestamp AS DATE) AS day, count(*) AS n FROM transactions GROUP BY 1",
    "gaps": """
        SELECT s.day FROM (SELECT CAST(unnest(generate_series(CAST(min(day) AS TIMESTAMP),
          CAST(max(day) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM daily) s
        WHERE s.day NOT IN (SELECT day FROM daily)""",
    "outliers": """
        SELECT * FROM transactions WHERE amount > (SELECT quantile_disc(amount, 0.999) FROM transactions)""",
    "wide_outliers": """
        SELECT * FROM transactions WHERE amount > (SELECT quantile_disc(amount, 0.95) FROM transactions)""",
    "early": """
        SELECT t.transaction_id, t.customer_id, t.txn_date AS child_date, c.signup_date AS parent_date,
          date_diff('day', t.txn_date, c.signup_date) AS days_before,
          c.segment, c.risk_band, c.kyc_status, c.last_updated_ts
        FROM transactions t JOIN customers c USING (customer_id) WHERE t.txn_date < c.signup_date""",
    "early_lines": """
        SELECT l.transaction_id, l.merchant_id, o.o_orderpriority,
          date_diff('day', l.txn_date, CAST(o.o_orderdate AS DATE)) AS days_before
        FROM lines l JOIN orders o ON l.transaction_id = o.o_orderkey
        WHERE l.txn_date < CAST(o.o_orderdate AS DATE)""",
    "overwrites": """
        SELECT c.customer_id, c.signup_date AS lifecycle_date, CAST(c.last_updated_ts AS DATE) AS updated_date,
          f.first_day, CAST(c.last_updated_ts AS DATE) > c.signup_date AS updated_after,
          date_diff('day', c.signup_date, CAST(c.last_updated_ts AS DATE)) AS days_after
        FROM customers c JOIN (SELECT customer_id, min(txn_date) AS first_day FROM transactions
          WHERE customer_id IS NOT NULL GROUP BY 1) f USING (customer_id)
        WHERE f.first_day < c.signup_date""",
    "enriched": """
        SELECT t.*, c.segment, c.risk_band, m.merchant_name, m.category,
          coalesce(t.amount > (SELECT quantile_disc(amount, 0.999) FROM transactions), false) AS is_amount_outlier,
          coalesce(t.amount < 0, false) AS is_negative_amount,
          coalesce(t.txn_date < c.signup_date, false) AS is_signup_date_suspect,
          t.customer_id IS NOT NULL AND c.customer_id IS NULL AS is_orphan_customer,
          t.merchant_id IS NOT NULL AND m.merchant_id IS NULL AS is_orphan_merchant,
          t.mcc_code IS NOT NULL AND t.mcc_code NOT IN
            (SELECT mcc_code FROM merchants WHERE mcc_code IS NOT NULL) AS is_unknown_mcc
        FROM transactions t LEFT JOIN customers_incomplete c ON t.customer_id = c.customer_id
        LEFT JOIN merchants m ON t.merchant_id = m.merchant_id""",
    "inventory": "\n UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{s}' AS sensitivity, "
        f"count(*) AS total_rows, count({c.split('.')[-1]}) AS populated_rows "
        f"FROM {'sessions' if t == 'device_session_logs' else t}" for t, c, s in PII_COLUMNS),
}


def _pairs(source: str) -> str:
    """Consecutive located fixes of each customer with distance, hours and speed."""
    return f"""
        SELECT *, round(dist / hours, 2) AS speed_kmh FROM (
          SELECT *, 2.0 * 6371 * asin(least(1.0, sqrt(
              pow(sin(radians(lat - prev_lat) / 2), 2)
              + cos(radians(prev_lat)) * cos(radians(lat)) * pow(sin(radians(long - prev_long) / 2), 2)))) AS dist,
            greatest((floor(epoch(event_timestamp)) - floor(epoch(prev_ts))) / 3600.0, 1 / 3600.0) AS hours
          FROM (SELECT *, lag(event_timestamp) OVER w AS prev_ts, lag(lat) OVER w AS prev_lat,
              lag(long) OVER w AS prev_long, lag(accuracy_m) OVER w AS prev_accuracy_m,
              lag(app_version) OVER w AS prev_app_version, lag(os) OVER w AS prev_os
            FROM {source} WHERE lat IS NOT NULL AND long IS NOT NULL
            WINDOW w AS (PARTITION BY customer_id ORDER BY event_timestamp, session_id)))"""


ROLES["enriched_all"] = ROLES["enriched"].replace("customers_incomplete", "customers")
ROLES["timed_clean"] = _pairs("clean_sessions")
ROLES["timed_dirty"] = _pairs("sessions")
ROLES["fast_clean"] = "SELECT * FROM timed_clean WHERE prev_ts IS NOT NULL AND speed_kmh > 900"
ROLES["fast_dirty"] = "SELECT * FROM timed_dirty WHERE prev_ts IS NOT NULL AND speed_kmh > 900"


def _ri(child: str, ck: str, parent: str, pk: str, label: str) -> str:
    orphan = f"{ck} NOT IN (SELECT {pk} FROM {parent} WHERE {pk} IS NOT NULL)"
    return f"""SELECT '{label}' AS check_name, count(*) AS non_null_rows,
        count(*) FILTER (WHERE {orphan}) AS orphan_rows,
        CASE WHEN count(*) > 0 THEN round(count(*) FILTER (WHERE {orphan}) / count(*) * 100, 4) ELSE 0.0 END
          AS orphan_pct,
        CASE WHEN count(*) FILTER (WHERE {orphan}) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
      FROM {child} WHERE {ck} IS NOT NULL"""


_RI_ALL = [
    ("transactions", "customer_id", "customers", "customer_id", "transactions.customer_id -> customers.customer_id"),
    ("transactions", "merchant_id", "merchants", "merchant_id", "transactions.merchant_id -> merchants.merchant_id"),
    ("transactions", "mcc_code", "merchants", "mcc_code", "transactions.mcc_code -> merchants.mcc_code"),
    ("sessions", "customer_id", "customers", "customer_id",
     "device_session_logs.customer_id -> customers.customer_id"),
    ("transactions", "customer_id", "customers_incomplete", "customer_id",
     "transactions.customer_id -> customers_incomplete.customer_id"),
]
ROLES["integrity"] = "\n UNION ALL ".join(_ri(*r) for r in _RI_ALL)


def with_roles(body: str) -> str:
    """Prepends all role expressions; the engine evaluates only those the body uses."""
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in ROLES.items())
    return f"WITH {ctes}\n{body}"


def _union(parts: list[str]) -> str:
    return "\n UNION ALL ".join(parts)


def _cast_check(column: str, kind: str, sql_type: str, table: str) -> str:
    bad = f"{column} IS NOT NULL AND TRY_CAST({column} AS {sql_type}) IS NULL"
    return f"""SELECT '{column}' AS column_name, '{kind}' AS expected_type, count({column}) AS non_null_rows,
        count(*) FILTER (WHERE {bad}) AS cast_failures,
        round(count(*) FILTER (WHERE {bad}) / count({column}) * 100, 2) AS failure_pct,
        CASE WHEN count(*) FILTER (WHERE {bad}) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM {table}"""


def _cardinality(table: str, columns: list[str]) -> str:
    def one(c: str) -> str:
        values = f"(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END))"
        return (f"SELECT '{c}' AS column_name, count(*) AS total_rows, {big(values)} AS distinct_values, "
                f"round(count(*) / {values}, 2) AS rows_per_value FROM {table}")
    return _union([one(c) for c in columns])


def _profile(table: str, pk: list[str], columns: list[str], nulls: dict[str, str] | None = None) -> str:
    keys = ", ".join(pk)
    everything = ", ".join(columns)
    nulls = nulls or {}
    parts = [
        f"SELECT 'rows' AS metric, CAST(NULL AS VARCHAR) AS column_name, count(*) AS value FROM {table}",
        f"SELECT 'full_row_duplicates', NULL, {big('count(*) - (SELECT count(*) FROM (SELECT DISTINCT ' + everything + ' FROM ' + table + '))')} FROM {table}",
        f"SELECT 'key_duplicates', '{','.join(pk)}', {big('count(*) - (SELECT count(*) FROM (SELECT DISTINCT ' + keys + ' FROM ' + table + '))')} FROM {table}",
    ]
    named = nulls or {c: f"{c} IS NULL" for c in columns}
    parts += [f"SELECT 'nulls', '{c}', count(*) FILTER (WHERE {cond}) FROM {table}" for c, cond in named.items()]
    return _union(parts)


_TXN_COLS = ["transaction_id", "card_id", "customer_id", "merchant_id", "txn_timestamp", "amount", "currency",
             "mcc_code", "channel", "txn_type", "status", "country", "is_fraud_flag", "txn_date"]
_LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_FLAT = ["session_id", "customer_id", "device_id", "event_type", "event_timestamp", "ip_address",
         "lat", "long", "city", "accuracy_m", "os", "app_version", "device_model"]


def _share(col: str) -> str:
    return (f"SELECT {col}, count(*) AS n, round(count(*) / (SELECT count(*) FROM transactions) * 100, 6) AS pct "
            f"FROM transactions GROUP BY 1")


def _outlier_dim(dim: str) -> str:
    return (f"SELECT {dim}, count(*) AS n, round(min(amount), 2) AS min_amount, round(max(amount), 2) AS max_amount, "
            "round(CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / count(amount), 2) AS avg_amount "
            f"FROM wide_outliers GROUP BY 1")


def _concentration(dim: str, key: str, detail: str, base: str | None) -> str:
    hit = f"SELECT {dim}, count(DISTINCT {key}) AS affected_keys, count(*) AS affected_rows FROM {detail} GROUP BY 1"
    if base is None:
        return hit
    return (f"SELECT h.*, t.total_keys, round(affected_keys / total_keys * 100, 2) AS affected_pct FROM ({hit}) h "
            f"LEFT JOIN (SELECT {dim}, count(*) AS total_keys FROM {base} GROUP BY 1) t USING ({dim})")


def _quantiles(table: str, col: str, probs: list[str]) -> str:
    return _union([f"SELECT CAST({p} AS DOUBLE) AS p, quantile_disc({col}, {p}) AS value, "
                   f"(SELECT count(*) FROM {table} WHERE {col} > (SELECT quantile_disc({col}, {p}) FROM {table})) AS above "
                   f"FROM {table}" for p in probs])


def _heavy(table: str, key: str) -> str:
    return f"""WITH per AS (SELECT {key}, count(*) AS n FROM {table} WHERE {key} IS NOT NULL GROUP BY 1),
      ranked AS (SELECT n, row_number() OVER (ORDER BY n DESC) AS r, count(*) OVER () AS keys FROM per)
      SELECT {big('max(keys)')} AS all_keys, {big('greatest(1, floor(max(keys) * 0.2))')} AS heavy_keys,
        {big('sum(n)')} AS all_rows, {big('sum(n) FILTER (WHERE r <= greatest(1, floor(keys * 0.2)))')} AS heavy_rows,
        round(sum(n) FILTER (WHERE r <= greatest(1, floor(keys * 0.2))) / sum(n), 6) AS heavy_share
      FROM ranked"""


def _range(table: str, label: str, col: str, fmt: str) -> str:
    return (f"SELECT '{label}' AS table_name, '{col}' AS column_name, strftime(min({col}), {fmt}) AS min_value, "
            f"strftime(max({col}), {fmt}) AS max_value FROM {table}")


def _nulls_in(flag: str, prefix: str, leaves: list[str]) -> list[str]:
    struct = f"SELECT '{prefix}__struct' AS field, count(*) FILTER (WHERE NOT {flag}) AS nulls FROM sessions"
    return [struct] + [
        f"SELECT '{prefix}__{c}', count(*) FILTER (WHERE {flag} AND {c} IS NULL) FROM sessions" for c in leaves]


def _edges(cols: str, n: int) -> str:
    return f"""SELECT * FROM (SELECT {cols}, 'oldest' AS edge FROM sessions ORDER BY event_timestamp, session_id LIMIT {n})
      UNION ALL SELECT * FROM (SELECT {cols}, 'newest' AS edge FROM sessions
        ORDER BY event_timestamp DESC, session_id DESC LIMIT {n})"""


_GEO = ["lat", "long", "city", "accuracy_m"]
_META = ["os", "app_version", "device_model"]

# Scorecard lines: (section, check, subject, value SQL); checks with a severity are judged below.
_FANOUT = [
    ("customers", "customers", ["customer_id"]), ("merchants", "merchants", ["merchant_id"]),
    ("transactions", "transactions", ["transaction_id", "customer_id", "card_id"]),
    ("device_session_logs", "sessions", ["session_id", "customer_id", "device_id"]),
]
_BLOCKERS = ("future_dated", "pre_signup", "impossible_velocity")
_WARNINGS = {"future_birth": "FAIL", "under_18": "FLAG", "over_100": "FLAG", "gap_days": "WARN",
             "amount_outliers": "WARN"}


def _line(section: int, check: str, subject: str, value: str, source: str) -> str:
    if check in _BLOCKERS:
        status, severity = f"CASE WHEN {value} > 0 THEN 'FAIL' ELSE 'PASS' END", "BLOCKER"
    elif check in _WARNINGS:
        status, severity = f"CASE WHEN {value} > 0 THEN '{_WARNINGS[check]}' ELSE 'PASS' END", "WARNING"
    else:
        status, severity = "'INFO'", "INFO"
    return (f"SELECT {big(str(section))} AS section, '{check}' AS check_name, '{subject}' AS subject, "
            f"CAST({value} AS DOUBLE) AS value, {status} AS status, '{severity}' AS severity FROM {source}")


def _distinct(c: str) -> str:
    return f"(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END))"


def _card_lines() -> str:
    parts = []
    for label, source, cols in _FANOUT:
        parts.append(_line(1, "total_rows", label, "count(*)", source))
        parts.append(_line(1, "distinct_pk", label, _distinct(cols[0]), source))
        parts += [_line(2, "rows_per_value", f"{label}.{c}", f"round(count(*) / {_distinct(c)}, 2)", source)
                  for c in cols[1:]]
    parts.append(f"SELECT {big('3')}, 'orphan_rows', check_name, CAST(orphan_rows AS DOUBLE), status, 'BLOCKER' "
                 "FROM integrity")
    for check, value in {
        "min_amount": "min(amount)", "max_amount": "max(amount)", "mean_amount": "round(avg(amount), 4)",
        "median_amount": "quantile_disc(amount, 0.5)", "stddev_amount": "round(stddev_samp(amount), 4)",
        "negative_count": "count(*) FILTER (WHERE amount < 0)", "zero_count": "count(*) FILTER (WHERE amount = 0)",
    }.items():
        parts.append(_line(4, check, "transactions.amount", value, "transactions"))
    parts += [
        _line(5, "future_dated", "transactions.txn_timestamp",
              f"count(*) FILTER (WHERE CAST(txn_timestamp AS DATE) > DATE '{TODAY}')", "transactions"),
        _line(5, "pre_signup", "transactions.txn_date", "count(*)", "early"),
        _line(5, "gap_days", "transactions.txn_timestamp", "count(*)", "gaps"),
        _line(5, "future_birth", "customers.dob", f"count(*) FILTER (WHERE dob > DATE '{TODAY}')", "customers"),
        _line(5, "under_18", "customers.dob",
              f"count(*) FILTER (WHERE dob > DATE '{TODAY}' - INTERVAL 18 YEAR)", "customers"),
        _line(5, "over_100", "customers.dob",
              f"count(*) FILTER (WHERE dob < DATE '{TODAY}' - INTERVAL 100 YEAR)", "customers"),
        _line(6, "amount_outliers", "transactions.amount", "count(*)", "outliers"),
        _line(6, "impossible_velocity", "device_session_logs.geo", "count(*)", "fast_dirty"),
    ]
    parts.append(f"SELECT {big('7')}, 'tagged_columns', sensitivity, CAST(count(*) AS DOUBLE), 'INFO', 'INFO' "
                 "FROM inventory GROUP BY sensitivity")
    return _union(parts)


_REASONS_TXN = """concat_ws(',',
    CASE WHEN transaction_id IS NULL THEN 'missing_transaction_id' END,
    CASE WHEN txn_timestamp IS NOT NULL AND p_ts IS NULL THEN 'bad_txn_timestamp' END,
    CASE WHEN amount IS NOT NULL AND p_amount IS NULL THEN 'bad_amount' END,
    CASE WHEN mcc_code IS NOT NULL AND p_mcc IS NULL THEN 'bad_mcc_code' END,
    CASE WHEN is_fraud_flag IS NOT NULL AND p_fraud IS NULL THEN 'bad_is_fraud_flag' END,
    CASE WHEN txn_date IS NOT NULL AND p_date IS NULL THEN 'bad_txn_date' END)"""
_REASONS_CUST = """concat_ws(',',
    CASE WHEN customer_id IS NULL THEN 'missing_customer_id' END,
    CASE WHEN TRY_CAST(dob AS DATE) IS NULL THEN 'bad_dob' END,
    CASE WHEN TRY_CAST(signup_date AS DATE) IS NULL THEN 'bad_signup_date' END)"""

_SCD2 = f"""
    SELECT user_id, event_type, {micro('ts')} AS valid_from, {micro('lead(ts) OVER w')} AS valid_to,
      lead(ts) OVER w IS NULL AS is_current
    FROM (SELECT user_id, event_type, ts, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events)
    WHERE prev IS NULL OR prev <> event_type WINDOW w AS (PARTITION BY user_id ORDER BY ts)"""

_MONTHLY = """SELECT channel, strftime(txn_date, '%Y-%m') AS month, count(*) AS txns,
    CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM enriched_all GROUP BY 1, 2"""

_FAST = "fast_clean"

_BODIES = {
    "profile_counts": _profile("transactions", ["transaction_id"], _TXN_COLS),
    "profile_lineitem": _profile("lineitem", ["l_orderkey", "l_linenumber"], _LINE_COLS),
    "profile_sessions": _profile(
        "sessions", ["customer_id"], _FLAT + ["has_geo", "has_meta"],
        {**{c: f"{c} IS NULL" for c in _FLAT[:6]}, "geo": "NOT has_geo", "device_meta": "NOT has_meta"}),
    "null_counts": _union([f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls "
                           "FROM transactions" for c in _TXN_COLS]),
    "pk_duplicates": "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS copies "
                     "FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "cast_validation": _union([
        _cast_check("txn_timestamp", "timestamp", "TIMESTAMP", "landed"),
        _cast_check("amount", "double", "DOUBLE", "landed"),
        _cast_check("mcc_code", "int", "INTEGER", "landed"),
        _cast_check("is_fraud_flag", "boolean", "BOOLEAN", "landed"),
        _cast_check("txn_date", "date", "DATE", "landed")]),
    "cast_validation_customers": _union([
        _cast_check("dob", "date", "DATE", "customers_landed"),
        _cast_check("signup_date", "date", "DATE", "customers_landed"),
        _cast_check("last_updated_ts", "timestamp", "TIMESTAMP", "customers_landed")]),
    "cardinality_transactions": _cardinality(
        "transactions", ["transaction_id", "card_id", "customer_id", "merchant_id"]),
    "cardinality_sessions": _cardinality("sessions", ["session_id", "device_id", "customer_id"]),
    "cardinality_lineitem": _cardinality("lineitem", ["l_orderkey", "l_suppkey", "l_partkey"]),
    "orphan_rate": "SELECT * FROM integrity",
    "orphan_rate_lineitem": _union([
        _ri("lineitem", "l_orderkey", "(SELECT * FROM orders WHERE o_orderkey % 13 <> 0)", "o_orderkey",
            "lineitem.l_orderkey -> orders.o_orderkey"),
        _ri("lineitem", "l_suppkey", "supplier", "s_suppkey", "lineitem.l_suppkey -> supplier.s_suppkey"),
        _ri("lineitem", "l_partkey", "part", "p_partkey", "lineitem.l_partkey -> part.p_partkey")]),
    "orphan_rows": "SELECT transaction_id, customer_id, amount FROM transactions WHERE customer_id IS NOT NULL "
                   "AND customer_id NOT IN (SELECT customer_id FROM customers_incomplete)",
    "null_fk_rows": f"SELECT transaction_id, merchant_id, {day('txn_date')} AS txn_date FROM transactions "
                    "WHERE customer_id IS NULL",
    "amount_stats": """SELECT count(amount) AS non_null_count, min(amount) AS min_amount, max(amount) AS max_amount,
        round(avg(amount), 4) AS mean_amount, round(stddev_samp(amount), 4) AS stddev_amount,
        count(*) FILTER (WHERE amount < 0) AS negative_count, count(*) FILTER (WHERE amount = 0) AS zero_count,
        quantile_disc(amount, 0.5) AS median_amount FROM transactions""",
    "amount_quantiles": _quantiles("transactions", "amount", ["0.001", "0.5", "0.95", "0.99", "0.999"]),
    "lineitem_price_quantiles": _quantiles("lineitem", "l_extendedprice", ["0.5", "0.999"]),
    "top_codes": _union([
        f"SELECT * FROM (SELECT CAST(mcc_code AS BIGINT) AS mcc_code, count(*) AS n, '{t}' AS source FROM {t} "
        "GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10)" for t in ("transactions", "merchants")]),
    "channel_share": _share("channel"),
    "status_share": _share("status"),
    "label_share": _share("is_fraud_flag"),
    "label_rate": "SELECT count(*) AS n, round(avg(CASE WHEN is_fraud_flag THEN 1 ELSE 0 END), 6) AS actual_rate, "
                  "CAST(0.018 AS DOUBLE) AS target_rate FROM transactions",
    "dirty_counts": "SELECT count(*) FILTER (WHERE customer_id IS NULL) AS null_key_rows, "
                    "count(*) FILTER (WHERE amount < 0) AS negative_amount_rows FROM transactions",
    "time_ranges": _union([
        _range("transactions", "transactions", "txn_timestamp", _SECOND),
        _range("transactions", "transactions", "txn_date", _DAY),
        _range("customers", "customers", "signup_date", _DAY), _range("customers", "customers", "dob", _DAY),
        _range("customers", "customers", "last_updated_ts", _SECOND),
        _range("merchants", "merchants", "onboarding_date", _DAY),
        _range("sessions", "device_session_logs", "event_timestamp", _SECOND)]),
    "future_dated": f"SELECT count(*) AS future_rows, CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS status "
                    f"FROM transactions WHERE CAST(txn_timestamp AS DATE) > DATE '{TODAY}'",
    "daily_volume": f"SELECT {day('day')} AS day, n FROM daily",
    "gap_days": f"SELECT {day('day')} AS day FROM gaps",
    "age_sanity": f"""SELECT count(*) FILTER (WHERE dob > DATE '{TODAY}') AS future_birth,
        count(*) FILTER (WHERE dob > DATE '{TODAY}' - INTERVAL 18 YEAR) AS under_18,
        count(*) FILTER (WHERE dob < DATE '{TODAY}' - INTERVAL 100 YEAR) AS over_100 FROM customers""",
    "txn_calendar_cols": f"SELECT {day('txn_date')} AS txn_date, strftime(txn_timestamp, '%Y') AS txn_year, "
                         "strftime(txn_timestamp, '%m') AS txn_month, count(*) AS n FROM transactions GROUP BY ALL",
    "partition_month": "SELECT CASE WHEN transaction_id % 4 <> 3 THEN strftime(txn_timestamp, '%Y-%m') END "
                       "AS partition_month, count(*) AS n FROM transactions GROUP BY 1",
    "first_seen": f"SELECT transaction_id, {day('min(txn_date)')} AS first_day FROM lines GROUP BY 1",
    "flatten_events": "SELECT session_id, customer_id, device_id, event_type, "
                      f"{micro('event_timestamp')} AS event_timestamp, ip_address, lat, long, city, accuracy_m, os, "
                      "app_version, device_model FROM sessions",
    "nested_nulls": "SELECT *, CASE WHEN nulls > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM ("
                    + _union(_nulls_in("has_geo", "geo", _GEO) + _nulls_in("has_meta", "device_meta", _META)) + ")",
    "geo_range_violations": """SELECT count(*) FILTER (WHERE lat < -90 OR lat > 90) AS invalid_lat,
        count(*) FILTER (WHERE long < -180 OR long > 180) AS invalid_long, min(lat) AS lat_min, max(lat) AS lat_max,
        min(long) AS long_min, max(long) AS long_max FROM sessions""",
    "schema_drift": "SELECT *, CASE WHEN null_oldest <> null_newest THEN 'DRIFT' ELSE 'OK' END AS status FROM ("
                    + _union([f"SELECT '{c}' AS sub_field, count(*) FILTER (WHERE edge = 'oldest' AND {c} IS NULL) "
                              f"AS null_oldest, count(*) FILTER (WHERE edge = 'newest' AND {c} IS NULL) AS null_newest "
                              f"FROM ({_edges(c, 100)})" for c in _GEO + _META]) + ")",
    "edge_samples": f"SELECT {micro('event_timestamp')} AS event_timestamp, session_id, edge FROM ("
                    + _edges("event_timestamp, session_id", 25) + ")",
    "amount_outliers": f"SELECT transaction_id, customer_id, merchant_id, amount, {micro('txn_timestamp')} "
                       "AS txn_timestamp, status, is_fraud_flag FROM outliers",
    "outliers_largest": "SELECT transaction_id, amount, channel, status FROM outliers "
                        "ORDER BY amount DESC, transaction_id LIMIT 30",
    "outlier_by_txn_type": _outlier_dim("txn_type"),
    "outlier_by_channel": _outlier_dim("channel"),
    "outlier_by_currency": _outlier_dim("currency"),
    "outlier_currency_share": "SELECT currency, count(*) AS n, round(count(*) / (SELECT count(*) FROM wide_outliers) "
                              "* 100, 6) AS pct FROM wide_outliers GROUP BY 1",
    "round_amounts": """SELECT count(*) AS n, count(*) FILTER (WHERE a % 1000 = 0) AS round_1000,
        count(*) FILTER (WHERE a % 100 = 0 AND a % 1000 <> 0) AS round_100
        FROM (SELECT CAST(floor(amount / 50) * 50 AS DECIMAL(18,2)) AS a FROM transactions)
        WHERE a > (SELECT quantile_disc(floor(amount / 50) * 50, 0.9) FROM transactions)""",
    "velocity_pairs": f"""SELECT customer_id, session_id, {micro('event_timestamp')} AS event_timestamp, lat, long,
        accuracy_m, app_version, os, {micro('prev_ts')} AS prev_ts, prev_lat, prev_long, prev_accuracy_m,
        prev_app_version, prev_os, round(dist, 3) AS dist_km, round(hours, 6) AS time_hours, speed_kmh
        FROM timed_clean WHERE prev_ts IS NOT NULL""",
    "velocity_impossible": "SELECT customer_id, session_id, speed_kmh FROM fast_dirty",
    "velocity_worst": f"SELECT customer_id, session_id, speed_kmh FROM {_FAST} "
                      "ORDER BY speed_kmh DESC, session_id LIMIT 20",
    "accuracy_stats": f"""SELECT count(*) AS pairs, count(*) FILTER (WHERE accuracy_m IS NULL) AS missing,
        min(accuracy_m) AS min_m, max(accuracy_m) AS max_m, round(avg(accuracy_m), 1) AS mean_m,
        quantile_disc(accuracy_m, 0.5) AS median_m, count(*) FILTER (WHERE accuracy_m > 1000) AS over_1km,
        count(*) FILTER (WHERE accuracy_m > 5000) AS over_5km, count(*) FILTER (WHERE accuracy_m > 10000) AS over_10km,
        count(*) FILTER (WHERE accuracy_m < 100) AS reliable FROM {_FAST}""",
    "pairs_by_app_version": f"SELECT app_version, count(*) AS pairs, count(DISTINCT customer_id) AS distinct_keys "
                            f"FROM {_FAST} GROUP BY 1",
    "pairs_by_os": f"SELECT os, count(*) AS pairs, count(DISTINCT customer_id) AS distinct_keys FROM {_FAST} GROUP BY 1",
    "pairs_top_customers": f"SELECT customer_id, count(*) AS pairs FROM {_FAST} GROUP BY 1 "
                           "ORDER BY pairs DESC, customer_id LIMIT 20",
    "pairs_top_devices": f"SELECT device_id, count(*) AS pairs FROM {_FAST} GROUP BY 1 "
                         "ORDER BY pairs DESC, device_id LIMIT 20",
    "label_rate_by_flag": f"""SELECT flagged, count(*) AS total_rows, count(*) FILTER (WHERE is_fraud_flag)
        AS labelled_rows, round(count(*) FILTER (WHERE is_fraud_flag) / count(*) * 100, 4) AS rate_pct
        FROM (SELECT is_fraud_flag, customer_id IS NOT NULL AND customer_id IN (SELECT customer_id FROM {_FAST})
          AS flagged FROM transactions) GROUP BY 1""",
    "geo_flags": """SELECT s.session_id, s.customer_id, t.speed_kmh,
        coalesce(t.speed_kmh > 900, false) AS is_geo_velocity_anomaly,
        coalesce(s.accuracy_m >= 100, false) AS is_geo_low_accuracy,
        s.accuracy_m IS NULL AS is_geo_accuracy_missing
        FROM sessions s LEFT JOIN (SELECT session_id, speed_kmh FROM timed_dirty WHERE prev_ts IS NOT NULL) t
        ON s.session_id = t.session_id""",
    "pre_lifecycle_rows": "SELECT count(*) AS pre_lifecycle_rows FROM early_lines",
    "lifecycle_summary": "SELECT count(*) AS affected_rows, count(DISTINCT customer_id) AS affected_keys FROM early",
    "lifecycle_worst": f"""SELECT customer_id, transaction_id, {day('parent_date')} AS parent_date,
        {day('child_date')} AS child_date, days_before, segment, risk_band, kyc_status,
        {micro('last_updated_ts')} AS last_updated_ts FROM early
        ORDER BY days_before DESC, transaction_id LIMIT 30""",
    "concentration_by_segment": _concentration("segment", "customer_id", "early", "customers"),
    "concentration_by_risk_band": _concentration("risk_band", "customer_id", "early", "customers"),
    "concentration_by_kyc": _concentration("kyc_status", "customer_id", "early", None),
    "concentration_by_priority": _concentration("o_orderpriority", "transaction_id", "early_lines", "orders"),
    "lifecycle_gap_stats": """SELECT min(days_before) AS min_days, max(days_before) AS max_days,
        round(avg(days_before), 1) AS mean_days, quantile_disc(days_before, 0.5) AS median_days,
        quantile_disc(days_before, 0.95) AS p95_days, quantile_disc(days_before, 0.99) AS p99_days,
        count(*) FILTER (WHERE days_before <= 1) AS within_1_day,
        count(*) FILTER (WHERE days_before <= 7) AS within_7_days,
        count(*) FILTER (WHERE days_before > 365) AS over_1_year FROM early_lines""",
    "gap_buckets": """SELECT CASE WHEN days_before <= 1 THEN '0-1 days' WHEN days_before <= 7 THEN '2-7 days'
        WHEN days_before <= 30 THEN '8-30 days' WHEN days_before <= 365 THEN '31-365 days'
        ELSE 'over 365 days' END AS gap_bucket, count(*) AS n FROM early GROUP BY 1""",
    "overwrite_stats": """SELECT count(*) AS affected, count(*) FILTER (WHERE updated_after) AS updated_after,
        round(avg(days_after) FILTER (WHERE updated_after), 1) AS mean_days_after,
        round(count(*) FILTER (WHERE updated_after) / count(*) * 100, 1) AS updated_pct FROM overwrites""",
    "overwrite_worst": f"""SELECT customer_id, {day('lifecycle_date')} AS lifecycle_date,
        {day('updated_date')} AS updated_date, {day('first_day')} AS first_day, updated_after, days_after
        FROM overwrites WHERE updated_after ORDER BY overwrites.days_after DESC, customer_id LIMIT 20""",
    "pii_inventory": "SELECT * FROM inventory",
    "pii_totals": f"SELECT sensitivity, count(*) AS tagged_columns, {big('sum(populated_rows)')} AS populated_values "
                  "FROM inventory GROUP BY 1",
    "mask_customer": f"""SELECT sha256(CAST(customer_id AS VARCHAR)) AS customer_id,
        CAST(NULL AS VARCHAR) AS full_name, CAST(NULL AS VARCHAR) AS dob, CAST(NULL AS VARCHAR) AS address, segment,
        {day('signup_date')} AS signup_date FROM customers""",
    "mask_sessions": """SELECT session_id, sha256(CAST(customer_id AS VARCHAR)) AS customer_id,
        sha256(device_id) AS device_id, CAST(NULL AS VARCHAR) AS ip_address, CAST(NULL AS DOUBLE) AS lat,
        sha256(city) AS city, accuracy_m FROM sessions""",
    "scorecard_lines": _card_lines(),
    "scorecard_findings": f"""SELECT check_name, subject, value, status, severity FROM ({_card_lines()})
        WHERE severity <> 'INFO' AND status NOT IN ('PASS', 'INFO', 'N/A')""",
    "verdict": f"""SELECT CASE WHEN blockers > 0 THEN 'RED' WHEN warnings > 0 THEN 'YELLOW' ELSE 'GREEN' END AS verdict,
        blockers, warnings FROM (SELECT count(*) FILTER (WHERE severity = 'BLOCKER') AS blockers,
          count(*) FILTER (WHERE severity = 'WARNING') AS warnings FROM ({_card_lines()})
          WHERE status NOT IN ('PASS', 'INFO', 'N/A'))""",
    "threshold_regression": f"""SELECT metric, observed, CAST(baseline AS DOUBLE) AS baseline,
        CAST(0.05 AS DOUBLE) AS tolerance,
        CASE WHEN metric = 'orphan_rate_pct' AND observed > baseline THEN 'FAIL'
          WHEN metric IN ('geo_velocity_anomaly_rate_pct', 'amount_outlier_rate_pct')
            AND observed - baseline > 0.05 THEN 'ALERT'
          WHEN metric = 'pre_signup_rate_pct' AND abs(observed - baseline) > 0.05 THEN 'ALERT'
          ELSE 'OK' END AS status
        FROM (SELECT 'pre_signup_rate_pct' AS metric, {DQ_THRESHOLDS['pre_signup_rate_pct']} AS baseline,
            round((SELECT count(*) FROM early) / (SELECT count(*) FROM transactions) * 100, 4) AS observed
          UNION ALL SELECT 'geo_velocity_anomaly_rate_pct', {DQ_THRESHOLDS['geo_velocity_anomaly_rate_pct']},
            round((SELECT count(*) FROM fast_dirty) / (SELECT count(*) FROM sessions) * 100, 4)
          UNION ALL SELECT 'amount_outlier_rate_pct', {DQ_THRESHOLDS['amount_outlier_rate_pct']},
            round((SELECT count(*) FROM outliers) / (SELECT count(*) FROM transactions) * 100, 4)
          UNION ALL SELECT 'orphan_rate_pct', {DQ_THRESHOLDS['orphan_rate_pct']}, (SELECT orphan_pct FROM integrity
            WHERE check_name LIKE '%customers_incomplete%'))""",
    "silver_transactions": f"""SELECT transaction_id, customer_id, {micro('p_ts')} AS txn_timestamp,
        CAST(p_amount AS DOUBLE) AS amount, CAST(p_mcc AS BIGINT) AS mcc_code, p_fraud AS is_fraud_flag,
        {day('p_date')} AS txn_date, coalesce(p_amount < 0, false) AS is_negative_amount
        FROM parsed WHERE {_REASONS_TXN} = ''""",
    "silver_customers": f"""SELECT customer_id, {day('CAST(dob AS DATE)')} AS dob,
        {day('CAST(signup_date AS DATE)')} AS signup_date, segment,
        {micro('last_updated_ts')} AS last_updated_ts FROM customers_landed
        WHERE {_REASONS_CUST} = ''""",
    "silver_merchants": f"""SELECT CAST(merchant_id AS VARCHAR) AS merchant_id, merchant_name,
        CAST(mcc_code AS BIGINT) AS mcc_code, category, country, {day('onboarding_date')} AS onboarding_date,
        CASE WHEN merchant_id % 7 <> 0 THEN CAST(CAST(merchant_risk_score AS DECIMAL(18,4)) AS DOUBLE) END
          AS merchant_risk_score FROM merchants""",
    "silver_sessions": f"""SELECT CAST(session_id AS VARCHAR) AS session_id,
        CASE WHEN session_id % 73 <> 0 THEN CAST(customer_id AS VARCHAR) END AS customer_id,
        {micro("date_trunc('second', event_timestamp)")} AS event_timestamp, lat FROM sessions
        WHERE session_id % 71 <> 0""",
    "quarantine_sessions": """SELECT CAST(session_id AS VARCHAR) AS session_id,
        CASE WHEN session_id % 73 <> 0 THEN CAST(customer_id AS VARCHAR) END AS customer_id,
        CASE WHEN session_id % 71 = 0 THEN 'late' ELSE strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S') END
          AS event_timestamp,
        'bad_event_timestamp' AS reject_reasons FROM sessions WHERE session_id % 71 = 0""",
    "quarantine_transactions": f"""SELECT * FROM (SELECT transaction_id, customer_id, amount, txn_date,
        {_REASONS_TXN} AS reject_reasons FROM parsed) WHERE reject_reasons <> ''""",
    "quarantine_customers": f"""SELECT * FROM (SELECT full_name, dob, signup_date, {_REASONS_CUST} AS reject_reasons
        FROM customers_landed) WHERE reject_reasons <> ''""",
    "silver_enriched": """SELECT transaction_id, customer_id, segment, risk_band, merchant_name, category,
        is_amount_outlier, is_negative_amount, is_signup_date_suspect, is_orphan_customer, is_orphan_merchant,
        is_unknown_mcc FROM enriched""",
    "silver_sessions_enriched": """SELECT s.session_id, s.customer_id, c.segment, c.risk_band,
        s.customer_id IS NOT NULL AND c.customer_id IS NULL AS is_orphan_customer
        FROM sessions s LEFT JOIN customers_incomplete c ON s.customer_id = c.customer_id""",
    "signup_suspects": f"""SELECT c.customer_id, {day('c.signup_date')} AS signup_date,
        coalesce(f.first_day < c.signup_date, false) AS is_signup_date_suspect FROM customers c LEFT JOIN
        (SELECT customer_id, min(txn_date) AS first_day FROM transactions GROUP BY 1) f
        ON c.customer_id = f.customer_id""",
    "dim_customer": f"""SELECT customer_id, full_name, segment, risk_band, kyc_status, n_name AS country, r_name AS region,
        {micro("CASE WHEN kyc_status = 'pending' THEN last_updated_ts - INTERVAL 30 DAY ELSE last_updated_ts END")}
          AS valid_from
        FROM customers LEFT JOIN nation ON nation_key = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "dim_merchant": f"""SELECT merchant_id, merchant_name, CAST(mcc_code AS BIGINT) AS mcc_code, category, country,
        {day('onboarding_date')} AS onboarding_date, merchant_risk_score FROM merchants""",
    "dim_date": f"""SELECT {day('d')} AS date_day, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
        day(d) AS day_of_month, isodow(d) AS iso_weekday, isodow(d) >= 6 AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(CAST(min(txn_date) AS TIMESTAMP), CAST(max(txn_date) AS TIMESTAMP),
          INTERVAL 1 DAY)) AS DATE) AS d FROM transactions)""",
    "fact_transactions": f"""SELECT transaction_id, customer_id, merchant_id, {day('txn_date')} AS txn_date, channel,
        status, currency, CAST(CAST(amount AS DECIMAL(18,2)) AS DOUBLE) AS amount, txn_type = 'refund' AS is_returned,
        is_fraud_flag, is_amount_outlier, is_negative_amount, is_signup_date_suspect, customer_id IS NULL AS is_missing_customer,
        is_orphan_customer, is_orphan_merchant, is_unknown_mcc FROM enriched_all""",
    "daily_fraud_summary": f"""SELECT {day('txn_date')} AS txn_date, count(*) AS txns,
        CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount,
        count(*) FILTER (WHERE is_fraud_flag) AS flagged_txns,
        CAST(sum(CASE WHEN is_fraud_flag THEN CAST(amount AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS flagged_amount,
        round(count(*) FILTER (WHERE is_fraud_flag) / count(*), 6) AS flagged_rate, '{LABEL_CAVEAT}' AS label_caveat
        FROM enriched_all GROUP BY enriched_all.txn_date""",
    "customer_risk_scorecard": f"""SELECT c.customer_id, c.segment, c.risk_band, c.kyc_status,
        count(e.transaction_id) AS txns,
        coalesce(CAST(sum(CAST(e.amount AS DECIMAL(18,2))) AS DOUBLE), 0.0) AS amount,
        count(*) FILTER (WHERE e.is_fraud_flag) AS flagged_txns,
        count(*) FILTER (WHERE e.is_amount_outlier) AS outlier_txns,
        count(*) FILTER (WHERE e.is_signup_date_suspect) AS pre_signup_txns, '{LABEL_CAVEAT}' AS label_caveat
        FROM customers c LEFT JOIN enriched_all e ON c.customer_id = e.customer_id GROUP BY ALL""",
    "merchant_performance_daily": f"""SELECT merchant_id, {day('txn_date')} AS txn_date, count(*) AS txns,
        CAST(sum(amount) AS DOUBLE) AS net_amount, count(*) FILTER (WHERE is_returned) AS returned,
        round(count(*) FILTER (WHERE is_returned) / count(*), 6) AS return_rate
        FROM lines GROUP BY merchant_id, lines.txn_date""",
    "channel_volume_trends": f"""SELECT *, lag(txns) OVER (PARTITION BY channel ORDER BY month) AS prev_txns,
        txns - lag(txns) OVER (PARTITION BY channel ORDER BY month) AS txn_change FROM ({_MONTHLY})""",
}

_BODIES.update({
    "scan_csv_roundtrip": f"""SELECT CAST(transaction_id AS VARCHAR) AS transaction_id,
        CAST(customer_id AS VARCHAR) AS customer_id, channel, {day('txn_date')} AS txn_date FROM transactions""",
    "scan_json_roundtrip": """SELECT CAST(session_id AS VARCHAR) AS session_id,
        CAST(customer_id AS VARCHAR) AS customer_id, device_id, event_type, ip_address, lat, long, city, accuracy_m,
        os, app_version, device_model FROM sessions""",
    "ingest_status": _union([
        f"SELECT '{name}' AS dataset, 'OK' AS status, count(*) AS total_rows FROM {source}" for name, source in (
            ("customers", "customers"), ("merchants", "merchants"), ("transactions", "transactions"),
            ("device_session_logs", "sessions"))]),
    "ingest_transactions": """SELECT landed.transaction_id, landed.customer_id, landed.amount, landed.txn_date,
        strftime(t.txn_timestamp, '%Y-%m') AS _partition_date, 'registry-run' AS _pipeline_run_id,
        CAST(NULL AS VARCHAR) AS _rescued_data
        FROM landed JOIN transactions t ON landed.transaction_id = CAST(t.transaction_id AS VARCHAR)""",
    "ingest_sessions": """SELECT CAST(session_id AS VARCHAR) AS session_id, CAST(customer_id AS VARCHAR) AS customer_id,
        lat, long, city, accuracy_m, os, app_version, CAST(NULL AS VARCHAR) AS _rescued_data FROM sessions""",
    "ingest_rescued": f"""SELECT customer_id, full_name, dob, signup_date, segment, risk_band, address, kyc_status, last_updated_ts,
        CASE WHEN k % 3 = 1 AND k % 5 = 0 THEN '{{"vip":"yes"}}'
          WHEN k % 3 = 2 AND k % 7 = 0 THEN '{{"_corrupt_record":"' || concat_ws(',', customer_id, full_name, dob, signup_date, segment,
            risk_band, address, kyc_status, last_updated_ts, 'one more') || '"}}' END AS _rescued_data
        FROM (SELECT customer_id AS k, CAST(customer_id AS VARCHAR) AS customer_id, full_name, CAST(dob AS VARCHAR) AS dob,
          CAST(signup_date AS VARCHAR) AS signup_date, segment, risk_band, address, kyc_status,
          strftime(last_updated_ts, {_SECOND}) AS last_updated_ts FROM customers)""",
    "ingest_schema_memory": """SELECT CAST(merchant_id AS VARCHAR) AS merchant_id, merchant_name, category,
        CASE WHEN merchant_id % 2 <> 0 THEN '{"vip":"yes"}' END AS _rescued_data,
        CASE WHEN merchant_id % 2 = 0 THEN 'first' ELSE 'second' END AS _pipeline_run_id FROM merchants""",
    "audit_cols": """SELECT 'registry-run' AS _pipeline_run_id, count(*) AS n, count(*) AS with_file,
        count(*) AS with_time FROM customers""",
})
_BODIES["table_roundtrip"] = _BODIES["dim_merchant"]

SQL: dict[str, str] = {name: with_roles(body) for name, body in _BODIES.items()}
SQL["heavy_share"] = _heavy("events", "user_id")
SQL["heavy_share_transactions"] = _heavy(
    "(SELECT CASE WHEN o_orderkey % 503 <> 0 THEN o_custkey END AS customer_id FROM orders)", "customer_id")
SQL["scd2_history"] = _SCD2
SQL["scd2_merged"] = _SCD2
SQL["scd2_merged_late"] = _SCD2
