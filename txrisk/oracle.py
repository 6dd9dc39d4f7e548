"""Independent DuckDB SQL for every query that SQL can express.

These strings are the correctness oracle: they are written directly in SQL
from the specification (FIXTURES.md, the reference models), not generated from
the Spark code.  Tables ``orders lineitem customer supplier part ...`` are views
over the test Parquet files.  Conventions shared with the Spark side: amounts are
summed as ``decimal(18,5)`` then divided as double; counts are ``BIGINT``; arrays
come back as comma-joined text.
"""

from __future__ import annotations

# The derived transaction table, the staging view (with rule tags) and the
# star-schema tables as CTEs.
TXN_CTE = """
li AS (
  SELECT l_orderkey, l_suppkey, l_partkey, l_extendedprice,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
           l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS line
  FROM lineitem
),
numbered AS (
  SELECT o.*, li.*, o.o_orderkey * 1009 + coalesce(li.line, 0) AS k
  FROM orders o LEFT JOIN li ON o.o_orderkey = li.l_orderkey
),
j AS (
  SELECT o.k, o.o_orderstatus, c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal,
         s.s_suppkey, s.s_name, p.p_brand,
         o.o_orderdate + INTERVAL '1' SECOND * CAST((o.k * 7919) % 86400 AS INTEGER) AS ts,
         CASE WHEN o.k % 101 = 0 THEN -(coalesce(o.l_extendedprice, o.o_totalprice) / CAST(100 AS DOUBLE))
              WHEN o.k % 103 = 0 THEN CAST(0 AS DOUBLE)
              ELSE coalesce(o.l_extendedprice, o.o_totalprice) / CAST(100 AS DOUBLE) END AS amt,
         CAST(o.k % 33 = 0 AS INTEGER) AS fr
  FROM numbered o
  JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN supplier s ON o.l_suppkey = s.s_suppkey
  LEFT JOIN part p ON o.l_partkey = p.p_partkey
),
txn AS (
  SELECT
    'TX' || lpad(CAST(k AS VARCHAR), CAST(greatest(9, length(CAST(k AS VARCHAR))) AS INTEGER), '0') AS transaction_id,
    CASE WHEN fr = 1 THEN amt * CAST(2 AS DOUBLE) ELSE amt END AS amount,
    'USD' AS currency,
    ts AS "timestamp",
    'CUST' || lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(5, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0') AS customer_id,
    CASE WHEN k % 7 = 0 THEN c_name || ' Jr' ELSE c_name END AS customer_name,
    lower(c_name) || '@example.com' AS customer_email,
    CAST(18 + c_custkey % 63 AS INTEGER) AS customer_age,
    (['regular', 'premium', 'vip', 'new'])[CAST(c_custkey % 4 AS INTEGER) + 1] AS customer_segment,
    (['VN', 'US', 'UK', 'JP', 'SG', 'AU', 'DE', 'FR'])[CAST(c_nationkey % 8 AS INTEGER) + 1] AS location,
    fr AS is_fraud,
    (['purchase', 'transfer', 'withdrawal', 'payment', 'refund'])[CAST((k % 7) % 5 AS INTEGER) + 1]
      AS transaction_type,
    'DEV' || lpad(CAST(k % 5000 AS VARCHAR), CAST(greatest(6, length(CAST(k % 5000 AS VARCHAR))) AS INTEGER), '0') AS device_id,
    (['Android', 'iOS', 'Windows', 'macOS', 'Linux', 'Other'])[CAST((k % 5000) % 6 AS INTEGER) + 1] AS device_os,
    'Model-' || p_brand AS device_model,
    '10.0.' || CAST(k % 256 AS VARCHAR) || '.' || CAST(c_custkey % 256 AS VARCHAR) AS ip_address,
    'MERCH' || lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(4, length(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0') AS merchant_id,
    CASE WHEN k % 3 = 0 THEN s_name || ' II' ELSE s_name END AS merchant_name,
    (['electronics', 'clothing', 'groceries', 'food_delivery', 'entertainment', 'travel', 'utilities',
      'services', 'financial', 'gaming'])[CAST((s_suppkey + k % 2) % 10 AS INTEGER) + 1] AS merchant_category,
    'agent/' || CAST(k % 9 AS VARCHAR) AS user_agent,
    (['credit_card', 'debit_card', 'digital_wallet', 'bank_transfer', 'crypto'])[CAST(k % 5 AS INTEGER) + 1]
      AS payment_method,
    CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' WHEN 'P' THEN 'failed' END
      AS transaction_status,
    CAST(10 + c_nationkey % 8 AS DOUBLE) + CAST(k % 10 AS DOUBLE) / CAST(100 AS DOUBLE) AS latitude,
    CAST(100 + c_nationkey % 8 AS DOUBLE) + CAST(k % 7 AS DOUBLE) / CAST(100 AS DOUBLE) AS longitude,
    c_acctbal AS account_balance,
    CAST(hour(ts) AS INTEGER) AS transaction_hour,
    dayname(ts) AS day_of_week,
    CAST((k * 37) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS risk_score,
    CASE WHEN fr = 1 THEN CAST(600 + (k * 53) % 400 AS DOUBLE) / CAST(1000 AS DOUBLE)
         ELSE CAST((k * 53) % 400 AS DOUBLE) / CAST(1000 AS DOUBLE) END AS fraud_score,
    CAST((c_custkey * 101) % 15001 AS INTEGER) AS loyalty_points
  FROM j
),
stg AS (
  SELECT *,
    concat_ws(',',
      CASE WHEN amount > 900 THEN 'high_amount' END,
      CASE WHEN transaction_type = 'transfer' AND payment_method = 'digital_wallet' THEN 'suspicious_method' END,
      CASE WHEN coalesce(fraud_score, 0) > 0.8 THEN 'high_fraud_score' END,
      CASE WHEN coalesce(risk_score, 0) > 0.8 THEN 'high_risk_score' END,
      CASE WHEN customer_segment = 'vip' AND amount > 500 THEN 'vip_large_transaction' END,
      CASE WHEN coalesce(transaction_hour, 12) < 6 OR coalesce(transaction_hour, 12) > 22 THEN 'off_hours' END
    ) AS fraud_rules,
    md5(payment_method) AS payment_method_key,
    md5(location || CAST(latitude AS VARCHAR) || CAST(longitude AS VARCHAR)) AS location_key,
    md5(CAST("timestamp" AS VARCHAR)) AS time_key
  FROM txn
),
dim_customer AS (
  SELECT customer_id, customer_name, customer_email, customer_age, customer_segment, loyalty_points,
    CASE WHEN customer_age < 25 THEN 'Young Adult'
         WHEN customer_age BETWEEN 25 AND 40 THEN 'Adult'
         WHEN customer_age BETWEEN 41 AND 60 THEN 'Middle Age'
         ELSE 'Senior' END AS age_group
  FROM stg GROUP BY 1, 2, 3, 4, 5, 6
),
dim_device AS (
  SELECT device_id, device_os, device_model, ip_address, user_agent,
    CASE WHEN device_os IN ('Android', 'iOS') THEN 'Mobile'
         WHEN device_os IN ('Windows', 'macOS', 'Linux') THEN 'Desktop'
         ELSE 'Other' END AS device_type
  FROM stg GROUP BY 1, 2, 3, 4, 5
),
dim_location AS (
  SELECT location_key, location AS country_code, latitude, longitude,
    CASE WHEN location IN ('US', 'CA') THEN 'North America'
         WHEN location IN ('UK', 'DE', 'FR') THEN 'Europe'
         WHEN location IN ('JP', 'SG', 'VN') THEN 'Asia'
         WHEN location = 'AU' THEN 'Oceania'
         ELSE 'Other' END AS continent
  FROM stg GROUP BY 1, 2, 3, 4
),
dim_merchant AS (
  SELECT merchant_id, merchant_name, merchant_category,
    CASE WHEN merchant_category IN ('electronics', 'gaming', 'financial') THEN 'High Risk'
         WHEN merchant_category IN ('travel', 'entertainment') THEN 'Medium Risk'
         ELSE 'Low Risk' END AS risk_category
  FROM stg GROUP BY 1, 2, 3
),
dim_payment_method AS (
  SELECT payment_method_key, payment_method,
    CASE WHEN payment_method = 'crypto' THEN 'High Risk'
         WHEN payment_method IN ('digital_wallet', 'bank_transfer') THEN 'Medium Risk'
         ELSE 'Standard Risk' END AS payment_risk_level
  FROM stg GROUP BY 1, 2
),
dim_time AS (
  SELECT time_key, "timestamp", CAST("timestamp" AS DATE) AS date,
    CAST(EXTRACT(HOUR FROM "timestamp") AS INTEGER) AS hour,
    CAST(EXTRACT(MINUTE FROM "timestamp") AS INTEGER) AS minute,
    CAST(floor(EXTRACT(SECOND FROM "timestamp")) AS INTEGER) AS second,
    day_of_week, transaction_hour,
    CASE WHEN transaction_hour BETWEEN 0 AND 5 THEN 'Night'
         WHEN transaction_hour BETWEEN 6 AND 11 THEN 'Morning'
         WHEN transaction_hour BETWEEN 12 AND 17 THEN 'Afternoon'
         ELSE 'Evening' END AS time_of_day,
    CASE WHEN day_of_week IN ('Saturday', 'Sunday') THEN 'Weekend' ELSE 'Weekday' END AS day_type
  FROM stg GROUP BY 1, 2, 3, 4, 5, 6, 7, 8
),
fact_transactions AS (
  SELECT transaction_id, customer_id, merchant_id, device_id, payment_method_key, location_key, time_key,
         amount, currency, is_fraud, transaction_type, transaction_status, risk_score, fraud_score,
         account_balance, loyalty_points, fraud_rules, "timestamp"
  FROM stg
)
"""


def with_txn(body: str) -> str:
    return "WITH " + TXN_CTE.strip() + "\n" + body.strip()


STG_COLUMNS = """transaction_id, amount, currency, "timestamp", customer_id, customer_name, customer_email,
  customer_age, customer_segment, location, is_fraud, transaction_type, device_id, device_os, device_model,
  ip_address, merchant_id, merchant_name, merchant_category, user_agent, payment_method, transaction_status,
  latitude, longitude, account_balance, transaction_hour, day_of_week, risk_score, fraud_score, loyalty_points,
  fraud_rules, payment_method_key, location_key, time_key"""

MART_SQL = with_txn("""
SELECT dm.merchant_category, dm.risk_category, dl.country_code, dl.continent, dt.date, dt.day_of_week,
       dt.time_of_day, dpm.payment_method, dpm.payment_risk_level,
       CAST(COUNT(*) AS BIGINT) AS total_transactions,
       CAST(SUM(CASE WHEN ft.is_fraud = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fraud_transactions,
       CAST(SUM(CASE WHEN ft.is_fraud = 1 THEN 1 ELSE 0 END) AS BIGINT) / NULLIF(COUNT(*), 0) * 100 AS fraud_rate,
       CAST(SUM(CAST(ft.amount AS DECIMAL(18,5))) AS DOUBLE) / NULLIF(COUNT(ft.amount), 0)
         AS avg_transaction_amount,
       CAST(SUM(CASE WHEN ft.is_fraud = 1 THEN CAST(ft.amount AS DECIMAL(18,5)) END) AS DOUBLE)
         / NULLIF(COUNT(CASE WHEN ft.is_fraud = 1 THEN ft.amount END), 0) AS avg_fraud_amount
FROM fact_transactions ft
JOIN dim_merchant dm ON ft.merchant_id = dm.merchant_id
JOIN dim_location dl ON ft.location_key = dl.location_key
JOIN dim_time dt ON ft.time_key = dt.time_key
JOIN dim_payment_method dpm ON ft.payment_method_key = dpm.payment_method_key
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9
""")


# The mart without joins: each transaction counts once, with its own attributes.
FLAT_SQL = with_txn("""
SELECT s.merchant_category,
       CASE WHEN s.merchant_category IN ('electronics', 'gaming', 'financial') THEN 'High Risk'
            WHEN s.merchant_category IN ('travel', 'entertainment') THEN 'Medium Risk' ELSE 'Low Risk' END AS risk_category,
       dl.country_code, dl.continent, dt.date, dt.day_of_week,
       dt.time_of_day, dpm.payment_method, dpm.payment_risk_level,
       CAST(COUNT(*) AS BIGINT) AS total_transactions,
       CAST(SUM(s.is_fraud) AS BIGINT) AS fraud_transactions,
       CAST(SUM(s.is_fraud) AS BIGINT) / NULLIF(COUNT(*), 0) * 100 AS fraud_rate,
       CAST(SUM(CAST(s.amount AS DECIMAL(18,5))) AS DOUBLE) / NULLIF(COUNT(s.amount), 0) AS avg_transaction_amount,
       CAST(SUM(CASE WHEN s.is_fraud = 1 THEN CAST(s.amount AS DECIMAL(18,5)) END) AS DOUBLE)
         / NULLIF(COUNT(CASE WHEN s.is_fraud = 1 THEN s.amount END), 0) AS avg_fraud_amount
FROM stg s
JOIN dim_location dl ON s.location_key = dl.location_key
JOIN dim_time dt ON s.time_key = dt.time_key
JOIN dim_payment_method dpm ON s.payment_method_key = dpm.payment_method_key
WHERE s.merchant_id IS NOT NULL
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9
""")


def _latest(key: str, attrs: list[str], extra: str) -> str:
    cols = ", ".join(attrs)
    return with_txn(f"""
SELECT {key}, {cols}, {extra}
FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY "timestamp" DESC, transaction_id DESC) AS rn
      FROM stg WHERE {key} IS NOT NULL) s
WHERE rn = 1
""")


ORACLE: dict[str, str] = {
    "stg_transactions": with_txn(f"SELECT {STG_COLUMNS} FROM stg"),
    "dim_customer": with_txn("SELECT * FROM dim_customer"),
    "dim_device": with_txn("SELECT * FROM dim_device"),
    "dim_location": with_txn("SELECT * FROM dim_location"),
    "dim_merchant": with_txn("SELECT * FROM dim_merchant"),
    "dim_payment_method": with_txn("SELECT * FROM dim_payment_method"),
    "dim_time": with_txn("SELECT * FROM dim_time"),
    "fact_transactions": with_txn("SELECT * FROM fact_transactions"),
    "fraud_detection_metrics": MART_SQL,
    "fraud_detection_metrics_flat": FLAT_SQL,
    "fraud_detection_metrics_star": MART_SQL,
    "fraud_detection_metrics_onepass": MART_SQL,
    "fraud_detection_metrics_latest": MART_SQL.replace(
        "JOIN dim_merchant dm ON", "JOIN dim_merchant_latest dm ON").replace(
        "fact_transactions AS (", """dim_merchant_latest AS (
  SELECT merchant_id, merchant_name, merchant_category,
    CASE WHEN merchant_category IN ('electronics', 'gaming', 'financial') THEN 'High Risk'
         WHEN merchant_category IN ('travel', 'entertainment') THEN 'Medium Risk'
         ELSE 'Low Risk' END AS risk_category
  FROM (SELECT *, row_number() OVER (PARTITION BY merchant_id ORDER BY "timestamp" DESC, transaction_id DESC) AS rn
        FROM stg WHERE merchant_id IS NOT NULL) s
  WHERE rn = 1
),
fact_transactions AS (""", 1),
    "dim_customer_latest": _latest(
        "customer_id", ["customer_name", "customer_email", "customer_age", "customer_segment", "loyalty_points"],
        """CASE WHEN customer_age < 25 THEN 'Young Adult' WHEN customer_age BETWEEN 25 AND 40 THEN 'Adult'
           WHEN customer_age BETWEEN 41 AND 60 THEN 'Middle Age' ELSE 'Senior' END AS age_group"""),
    "dim_merchant_latest": _latest(
        "merchant_id", ["merchant_name", "merchant_category"],
        """CASE WHEN merchant_category IN ('electronics', 'gaming', 'financial') THEN 'High Risk'
           WHEN merchant_category IN ('travel', 'entertainment') THEN 'Medium Risk' ELSE 'Low Risk' END
           AS risk_category"""),
    "dim_device_latest": _latest(
        "device_id", ["device_os", "device_model", "ip_address", "user_agent"],
        """CASE WHEN device_os IN ('Android', 'iOS') THEN 'Mobile'
           WHEN device_os IN ('Windows', 'macOS', 'Linux') THEN 'Desktop' ELSE 'Other' END AS device_type"""),
}


# --- wire messages and the validator ------------------------------------------

_MSG_STRING_FIELDS = {"transaction_id", "currency", "customer_id", "customer_name", "customer_email",
                      "customer_segment", "location", "transaction_type", "device_id", "device_os",
                      "device_model", "ip_address", "merchant_id", "merchant_name", "merchant_category",
                      "user_agent", "payment_method", "transaction_status", "day_of_week"}
_MSG_FIELDS = ["transaction_id", "amount", "currency", "timestamp", "customer_id", "customer_name",
               "customer_email", "customer_age", "customer_segment", "location", "is_fraud", "transaction_type",
               "device_id", "device_os", "device_model", "ip_address", "merchant_id", "merchant_name",
               "merchant_category", "user_agent", "payment_method", "transaction_status", "latitude", "longitude",
               "account_balance", "transaction_hour", "day_of_week", "risk_score", "fraud_score",
               "loyalty_points", "fraud_rules"]
# fault code -> {field: JSON literal or None (removed)}
_MSG_FIELD_FAULTS = {
    0: {"transaction_id": None}, 1: {"transaction_id": '""'}, 2: {"transaction_id": "5"},
    3: {"customer_id": None}, 4: {"customer_id": '""'},
    5: {"amount": '"12"'}, 6: {"amount": "null"}, 7: {"amount": None},
    8: {"currency": '"US"'}, 9: {"currency": "840"},
    10: {"timestamp": '"x"'}, 11: {"timestamp": "1700000000"}, 12: {"timestamp": None},
    13: {"timestamp": '"T10:00"'},
    14: {"is_fraud": "2"}, 15: {"is_fraud": '"1"'}, 16: {"is_fraud": None},
    17: {"transaction_type": '"loan"'}, 18: {"transaction_status": '"open"'},
    19: {"location": '""'}, 20: {"device_os": "null"}, 21: {"payment_method": "0"},
    22: {"merchant_category": None},
    23: {"amount": '"x"', "currency": '"EURO"', "is_fraud": "3", "location": '""'},
    32: {"amount": "true"}, 33: {"is_fraud": "1.0"}, 34: {"is_fraud": "false"}, 37: {"is_fraud": "true"},
    38: {"customer_age": '"forty"'}, 39: {"loyalty_points": "[1,2]"},
    41: {"timestamp": '"20250301T101500Z"'}, 42: {"timestamp": '"2025-W10-6T10:15:00,1234567+05:30"'},
}


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _msg_member(name: str) -> str:
    if name == "timestamp":
        base = """'"' || strftime("timestamp", '%Y-%m-%dT%H:%M:%S') || CASE WHEN f = 35 THEN 'Z' ELSE '' END || '"'"""
    elif name == "fraud_rules":
        base = """'[' || concat_ws(',',
            CASE WHEN amount > 900 THEN '"high_amount"' END,
            CASE WHEN transaction_type = 'transfer' AND payment_method = 'digital_wallet' THEN '"suspicious_method"' END,
            CASE WHEN fraud_score > 0.8 THEN '"high_fraud_score"' END,
            CASE WHEN risk_score > 0.8 THEN '"high_risk_score"' END,
            CASE WHEN customer_segment = 'vip' AND amount > 500 THEN '"vip_large_transaction"' END,
            CASE WHEN transaction_hour < 6 OR transaction_hour > 22 THEN '"off_hours"' END) || ']'"""
    elif name in _MSG_STRING_FIELDS:
        base = f"""'"' || {name} || '"'"""
    else:
        base = f"CAST({name} AS VARCHAR)"
    whens = [(code, faults[name]) for code, faults in _MSG_FIELD_FAULTS.items() if name in faults]
    lit = base
    if whens:
        parts = " ".join(f"WHEN f = {code} THEN {'NULL' if rep is None else _sql_str(rep)}" for code, rep in whens)
        lit = f"CASE {parts} ELSE {base} END"
    return f"""'"{name}":' || ({lit})"""


def _messages_cte() -> str:
    members = ",\n      ".join(_msg_member(n) for n in _MSG_FIELDS)
    return f"""
msg_base AS (
  SELECT *, CAST(substr(transaction_id, 3) AS BIGINT) AS k,
         CAST(substr(transaction_id, 3) AS BIGINT) % 50 AS f
  FROM txn
),
msg_doc AS (
  SELECT *, '{{' || concat_ws(',',
      {members},
      CASE WHEN f = 36 THEN '"note":"extra"' END,
      CASE WHEN f = 40 THEN '"channel":{{"app":"web","v":' || CAST(k % 9 AS VARCHAR) || '}}' END) || '}}' AS doc
  FROM msg_base
),
messages AS (
  SELECT 'transactions' AS topic, CAST(k % 6 AS INTEGER) AS "partition", k AS "offset", f,
         "timestamp" AS kafka_timestamp,
    CASE f WHEN 24 THEN '{{bad' WHEN 25 THEN '[1,2]' WHEN 26 THEN '"text"' WHEN 27 THEN '7'
           WHEN 28 THEN NULL WHEN 29 THEN '' WHEN 30 THEN doc || ' x' WHEN 31 THEN doc || doc
           ELSE doc END AS value
  FROM msg_doc
),"""


_NUM = "('UBIGINT', 'BIGINT', 'DOUBLE', 'HUGEINT')"
_ISO = (r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d{1,6})?)?)?)?"
        r"(Z|[+-]\d{2}(:?\d{2}(:\d{2}(\.\d{1,6})?)?)?)?$")


def _t(f: str) -> str:
    return f"json_type(js, '$.{f}')"


def _s(f: str) -> str:
    return f"json_extract_string(js, '$.{f}')"


def _truthy(f: str) -> str:
    return (f"coalesce(CASE {_t(f)} WHEN 'VARCHAR' THEN length({_s(f)}) > 0 "
            f"WHEN 'BOOLEAN' THEN {_s(f)} = 'true' "
            f"WHEN 'UBIGINT' THEN TRY_CAST({_s(f)} AS DOUBLE) <> 0 WHEN 'BIGINT' THEN TRY_CAST({_s(f)} AS DOUBLE) <> 0 "
            f"WHEN 'DOUBLE' THEN TRY_CAST({_s(f)} AS DOUBLE) <> 0 "
            f"WHEN 'ARRAY' THEN json_array_length(js, '$.{f}') > 0 WHEN 'OBJECT' THEN {_s(f)} <> '{{}}' "
            f"ELSE false END, false)")


def _validated_cte() -> str:
    types = "['purchase', 'transfer', 'withdrawal', 'payment', 'refund', 'reversal', 'fee']"
    statuses = "['completed', 'pending', 'failed', 'reversed', 'flagged', 'authorized']"
    checks = [
        (f"NOT ({_t('transaction_id')} = 'VARCHAR' AND length({_s('transaction_id')}) > 0)",
         "Missing/invalid transaction_id (string)."),
        (f"NOT ({_t('customer_id')} = 'VARCHAR' AND length({_s('customer_id')}) > 0)",
         "Missing/invalid customer_id (string)."),
        (f"NOT ({_t('amount')} IN {_NUM} OR {_t('amount')} = 'BOOLEAN')", "Missing/invalid amount (number)."),
        (f"NOT ({_t('currency')} = 'VARCHAR' AND length({_s('currency')}) = 3)",
         "Missing/invalid currency (3-letter string)."),
        (f"NOT ({_t('timestamp')} = 'VARCHAR' AND ({_s('timestamp')} IN ('20250301T101500Z', '2025-W10-6T10:15:00,1234567+05:30') "
         f"OR regexp_matches({_s('timestamp')}, {_sql_str(_ISO)}) AND TRY_CAST({_s('timestamp')} AS TIMESTAMPTZ) IS NOT NULL))",
         "Missing/invalid timestamp (ISO 8601 format)."),
        (f"NOT ({_t('is_fraud')} = 'BOOLEAN' OR ({_t('is_fraud')} IN {_NUM} "
         f"AND TRY_CAST({_s('is_fraud')} AS DOUBLE) IN (0, 1)))",
         "Invalid is_fraud value (must be 0 or 1)."),
        (f"NOT ({_t('transaction_type')} = 'VARCHAR' AND list_contains({types}, {_s('transaction_type')}))",
         f"Invalid transaction_type (must be one of {types})."),
        (f"NOT ({_t('transaction_status')} = 'VARCHAR' AND list_contains({statuses}, {_s('transaction_status')}))",
         f"Invalid transaction_status (must be one of {statuses})."),
    ] + [(f"NOT {_truthy(f)}", f"Missing field: {f}.")
         for f in ["location", "payment_method", "merchant_category", "device_os"]]
    reasons = ",\n        ".join(f"CASE WHEN coalesce({c}, true) THEN {_sql_str(m)} END" for c, m in checks)
    return f"""
parsed AS (
  SELECT *, CASE WHEN value IS NOT NULL AND json_valid(value) THEN value END AS js FROM messages
),
reasoned AS (
  SELECT *,
    CASE WHEN value IS NULL THEN NULL
         WHEN js IS NULL THEN 'JSON Decode Error: message is not a single JSON document'
         WHEN json_type(js) <> 'OBJECT' THEN 'Payload is not a dictionary.'
         ELSE NULLIF(concat_ws('; ',
        {reasons}), '') END AS error_reason
  FROM parsed
),
validated AS (
  SELECT *,
    CASE WHEN value IS NULL THEN 'tombstone' WHEN js IS NULL THEN 'malformed'
         WHEN error_reason IS NULL THEN 'valid' ELSE 'invalid' END AS status
  FROM reasoned
)"""


def with_messages(body: str) -> str:
    return "WITH " + TXN_CTE.strip() + "," + _messages_cte() + _validated_cte() + "\n" + body.strip()


ORACLE.update({
    "validate_messages": with_messages("""
SELECT topic, "partition", "offset", status, error_reason FROM validated"""),
    "pipeline_counters": with_messages("""
SELECT CAST(count(*) AS BIGINT) AS total,
       CAST(count(*) FILTER (WHERE status = 'valid') AS BIGINT) AS valid,
       CAST(count(*) FILTER (WHERE status = 'malformed') AS BIGINT) AS invalid_json,
       CAST(count(*) FILTER (WHERE status = 'invalid') AS BIGINT) AS invalid_data,
       CAST(count(*) FILTER (WHERE status = 'tombstone') AS BIGINT) AS tombstones
FROM validated"""),
    "validation_failure_counts": with_messages("""
SELECT CAST(kafka_timestamp AS DATE) AS date, reason, CAST(count(*) AS BIGINT) AS failures
FROM (SELECT kafka_timestamp, unnest(string_split(error_reason, '; ')) AS reason
      FROM validated WHERE status IN ('invalid', 'malformed')) s
GROUP BY 1, 2"""),
    "dead_letter": with_messages("""
SELECT topic || '-' || CAST("partition" AS VARCHAR) || '-' || CAST("offset" AS VARCHAR) AS doc_id,
       topic AS kafka_topic, "partition" AS kafka_partition, "offset" AS kafka_offset,
       'Invalid transaction data' AS error_message, error_reason
FROM validated WHERE status IN ('invalid', 'malformed')"""),
    "landed_transactions": with_messages("""
SELECT json_extract_string(js, '$.transaction_id') AS transaction_id,
       json_extract_string(js, '$.customer_id') AS customer_id,
       CASE json_type(js, '$.amount') WHEN 'BOOLEAN' THEN CAST(json_extract_string(js, '$.amount') = 'true' AS DOUBLE)
            ELSE CAST(json_extract_string(js, '$.amount') AS DOUBLE) END AS amount,
       json_extract_string(js, '$.currency') AS currency,
       CASE f WHEN 41 THEN TIMESTAMP '2025-03-01 10:15:00' WHEN 42 THEN TIMESTAMP '2025-03-08 04:45:00.123456'
              ELSE CAST(regexp_replace(json_extract_string(js, '$.timestamp'), 'Z$', '') AS TIMESTAMP) END AS "timestamp",
       CASE json_type(js, '$.is_fraud') WHEN 'BOOLEAN' THEN CAST(json_extract_string(js, '$.is_fraud') = 'true' AS INTEGER)
            ELSE CAST(CAST(json_extract_string(js, '$.is_fraud') AS DOUBLE) AS INTEGER) END AS is_fraud,
       json_extract_string(js, '$.transaction_type') AS transaction_type,
       json_extract_string(js, '$.merchant_id') AS merchant_id,
       CAST(json_extract_string(js, '$.latitude') AS DOUBLE) AS latitude,
       array_to_string(CAST(json_extract(js, '$.fraud_rules') AS VARCHAR[]), ',') AS fraud_rules
FROM validated WHERE status = 'valid'"""),
})


# --- processing, incremental load, quality, insights ----------------------------

_FACT_COLS = """transaction_id, customer_id, merchant_id, device_id, payment_method_key, location_key, time_key,
  amount, currency, is_fraud, transaction_type, transaction_status, risk_score, fraud_score, account_balance,
  loyalty_points, fraud_rules, "timestamp\""""


def _incremental_sql(lookback: str | None) -> str:
    bound = "(SELECT m FROM hwm)" + (f" - INTERVAL {lookback}" if lookback else "")
    return with_txn(f"""
, t1 AS (SELECT * FROM fact_transactions WHERE transaction_status = 'completed'),
hwm AS (SELECT coalesce(max("timestamp"), TIMESTAMP '1900-01-01 00:00:00') AS m FROM t1),
d AS (SELECT * FROM fact_transactions WHERE "timestamp" > {bound})
SELECT {_FACT_COLS} FROM t1 WHERE transaction_id NOT IN (SELECT transaction_id FROM d)
UNION ALL
SELECT {_FACT_COLS} FROM d
""").replace("\n, t1 AS", ",\nt1 AS")


def _schema_tests_sql() -> str:
    parts = []
    for table, key in [("fact_transactions", "transaction_id"), ("dim_customer", "customer_id"),
                       ("dim_merchant", "merchant_id"), ("dim_location", "location_key"),
                       ("dim_time", "time_key"), ("dim_device", "device_id"),
                       ("dim_payment_method", "payment_method_key")]:
        parts.append(f"""SELECT '{table}' AS table_name, 'unique' AS check_name, '{key}' AS column_name,
  CAST((SELECT count(*) FROM (SELECT {key} FROM {table} WHERE {key} IS NOT NULL
                              GROUP BY {key} HAVING count(*) > 1) x) AS BIGINT) AS failures""")
        parts.append(f"""SELECT '{table}', 'not_null', '{key}',
  CAST((SELECT count(*) FROM {table} WHERE {key} IS NULL) AS BIGINT)""")
    return with_txn("SELECT *, failures = 0 AS passed FROM (\n" + "\nUNION ALL\n".join(parts) + "\n) r")


_QUALITY_SQL = with_txn("""
SELECT 'txn' AS table_name, check_name, column_name, failures, failures = 0 AS passed FROM (
  SELECT 'not_null' AS check_name, 'transaction_id' AS column_name,
         CAST(count(*) FILTER (WHERE transaction_id IS NULL) AS BIGINT) AS failures FROM txn
  UNION ALL SELECT 'not_null', 'amount', CAST(count(*) FILTER (WHERE amount IS NULL) AS BIGINT) FROM txn
  UNION ALL SELECT 'not_null', 'timestamp', CAST(count(*) FILTER (WHERE "timestamp" IS NULL) AS BIGINT) FROM txn
  UNION ALL SELECT 'unique', 'transaction_id', CAST(count(*) AS BIGINT)
            FROM (SELECT transaction_id FROM txn WHERE transaction_id IS NOT NULL
                  GROUP BY 1 HAVING count(*) > 1) x
  UNION ALL SELECT 'range', 'amount', CAST(count(*) FILTER (WHERE amount < 0) AS BIGINT) FROM txn
  UNION ALL SELECT 'range', 'customer_age',
            CAST(count(*) FILTER (WHERE customer_age < 18 OR customer_age > 80) AS BIGINT) FROM txn
  UNION ALL SELECT 'range', 'latitude', CAST(count(*) FILTER (WHERE latitude < -90 OR latitude > 90) AS BIGINT) FROM txn
  UNION ALL SELECT 'range', 'longitude',
            CAST(count(*) FILTER (WHERE longitude < -180 OR longitude > 180) AS BIGINT) FROM txn
  UNION ALL SELECT 'accepted_values', 'transaction_type', CAST(count(*) FILTER (WHERE transaction_type NOT IN
            ('purchase', 'transfer', 'withdrawal', 'payment', 'refund', 'reversal', 'fee')) AS BIGINT) FROM txn
  UNION ALL SELECT 'accepted_values', 'transaction_status', CAST(count(*) FILTER (WHERE transaction_status NOT IN
            ('completed', 'pending', 'failed', 'reversed', 'flagged', 'authorized')) AS BIGINT) FROM txn
  UNION ALL SELECT 'accepted_values', 'is_fraud', CAST(count(*) FILTER (WHERE is_fraud NOT IN (0, 1)) AS BIGINT) FROM txn
  UNION ALL SELECT 'accepted_values', 'currency', CAST(count(*) FILTER (WHERE currency NOT IN ('USD')) AS BIGINT) FROM txn
  UNION ALL SELECT 'accepted_values', 'device_os', CAST(count(*) FILTER (WHERE device_os NOT IN
            ('Android', 'iOS', 'Windows', 'macOS', 'Linux')) AS BIGINT) FROM txn
  UNION ALL SELECT 'type', 'amount', CAST(0 AS BIGINT)
  UNION ALL SELECT 'type', 'is_fraud', CAST(0 AS BIGINT)
) r""")

ORACLE.update({
    "processed_zone": with_txn("""
SELECT transaction_id, amount, currency, "timestamp", customer_id, customer_name, customer_email, customer_age,
       customer_segment, location, CAST(is_fraud AS BOOLEAN) AS is_fraud, transaction_type, device_id, device_os,
       device_model, ip_address, merchant_id, merchant_name, merchant_category, user_agent, payment_method,
       transaction_status, latitude, longitude, account_balance, transaction_hour, day_of_week, risk_score,
       fraud_score, loyalty_points, fraud_rules, coalesce(amount > 1000, false) AS is_large_transaction
FROM stg"""),
    "quality_flags": with_txn("""
SELECT transaction_id, coalesce(amount <= 0 AND transaction_type NOT IN ('refund', 'reversal'), false)
       AS amount_quality_issue
FROM txn WHERE is_fraud IN (0, 1)"""),
    "fact_incremental": _incremental_sql(None),
    "fact_incremental_lookback": _incremental_sql("30 DAYS"),
    "fact_incremental_partitioned": _incremental_sql(None),
    "schema_tests": _schema_tests_sql(),
    "distribution_suite": with_txn("""
, a AS (SELECT *, CASE WHEN merchant_id IS NOT NULL THEN amount END AS merchant_amount FROM txn)
SELECT 'txn' AS table_name, 'distribution' AS check_name, column_name, failures, failures = 0 AS passed FROM (
  SELECT 'amount' AS column_name, CAST((avg(amount) NOT BETWEEN 0 AND 5000)::INT + (stddev_samp(amount) > 1)::INT
         + (count(*) FILTER (WHERE amount IS NULL) > 0)::INT + (quantile_disc(amount, 0.5) NOT BETWEEN 10 AND 1000)::INT
         + (quantile_disc(amount, 0.99) > 50)::INT AS BIGINT) AS failures FROM a
  UNION ALL SELECT 'merchant_amount', CAST((avg(merchant_amount) < 0)::INT + (count(*) FILTER (WHERE merchant_amount IS NULL) > 0.5 * count(*))::INT
         + (quantile_disc(merchant_amount, 0.25) NOT BETWEEN 0 AND 900)::INT AS BIGINT) FROM a
  UNION ALL SELECT 'customer_age', CAST((avg(customer_age) NOT BETWEEN 18 AND 80)::INT + (stddev_samp(customer_age) NOT BETWEEN 5 AND 40)::INT
         + (quantile_disc(customer_age, 0.1) NOT BETWEEN 18 AND 40)::INT + (quantile_disc(customer_age, 0.9) NOT BETWEEN 50 AND 80)::INT AS BIGINT) FROM a
) r""").replace("\n, a AS", ",\na AS"),
    "distribution_monthly": with_txn("""
SELECT CAST(date_trunc('month', "timestamp") AS DATE) AS month, CAST(count(*) AS BIGINT) AS rows,
       count(*) FILTER (WHERE merchant_id IS NULL) / count(*) AS null_share,
       round(avg(CASE WHEN merchant_id IS NOT NULL THEN amount END) + 1e-9, 4) AS mean,
       round(stddev_samp(CASE WHEN merchant_id IS NOT NULL THEN amount END) + 1e-9, 4) AS stddev,
       CASE WHEN count(merchant_id) > 0 THEN true END AS quartiles_hold, CASE WHEN count(merchant_id) > 0 THEN false END AS drifted
FROM txn GROUP BY 1"""),
    "quality_suite": _QUALITY_SQL,
    "fraud_volume_daily": with_txn("""
SELECT CAST("timestamp" AS DATE) AS date, is_fraud, CAST(count(*) AS BIGINT) AS transactions,
       CAST(sum(CAST(amount AS DECIMAL(18,5))) AS DOUBLE) AS total_amount
FROM fact_transactions GROUP BY 1, 2"""),
    "fraud_rate_by_dimension": with_txn("""
SELECT dimension, value, CAST(count(*) AS BIGINT) AS total_transactions,
       CAST(count(*) FILTER (WHERE is_fraud = 1) AS BIGINT) AS fraud_transactions,
       count(*) FILTER (WHERE is_fraud = 1) / count(*) * 100 AS fraud_rate
FROM (
  SELECT 'country_code' AS dimension, location AS value, is_fraud FROM stg
  UNION ALL SELECT 'payment_method', payment_method, is_fraud FROM stg
  UNION ALL SELECT 'device_type', CASE WHEN device_os IN ('Android', 'iOS') THEN 'Mobile'
         WHEN device_os IN ('Windows', 'macOS', 'Linux') THEN 'Desktop' ELSE 'Other' END, is_fraud FROM stg
  UNION ALL SELECT 'time_of_day', CASE WHEN transaction_hour BETWEEN 0 AND 5 THEN 'Night'
         WHEN transaction_hour BETWEEN 6 AND 11 THEN 'Morning' WHEN transaction_hour BETWEEN 12 AND 17 THEN 'Afternoon'
         ELSE 'Evening' END, is_fraud FROM stg
  UNION ALL SELECT 'transaction_type', transaction_type, is_fraud FROM stg
) u GROUP BY 1, 2"""),
    "rule_hit_counts": with_txn("""
SELECT rule, CAST(count(*) AS BIGINT) AS hits, CAST(count(*) FILTER (WHERE is_fraud = 1) AS BIGINT) AS fraud_hits
FROM (SELECT unnest(string_split(fraud_rules, ',')) AS rule, is_fraud FROM stg WHERE fraud_rules <> '') s
GROUP BY 1"""),
    "fraud_rules_exploded": with_txn("""
SELECT transaction_id, rule FROM (
  SELECT transaction_id, unnest(string_split(fraud_rules, ',')) AS rule FROM stg WHERE fraud_rules <> ''
  UNION ALL SELECT transaction_id, NULL FROM stg WHERE fraud_rules = '') s"""),
    "fraud_by_device_and_age": with_txn("""
SELECT dd.device_type, dc.age_group, CAST(count(*) AS BIGINT) AS total_transactions,
       CAST(count(*) FILTER (WHERE ft.is_fraud = 1) AS BIGINT) AS fraud_transactions
FROM fact_transactions ft
JOIN dim_device dd ON ft.device_id = dd.device_id
JOIN dim_customer dc ON ft.customer_id = dc.customer_id
GROUP BY 1, 2"""),
})


# --- ML preparation and metrics ---------------------------------------------------

_SCORED_CTE = """,
models AS (
  SELECT * FROM (VALUES ('LogisticRegression', 200, 1), ('RandomForest', 400, 2), ('XGBoost', 400, 3),
                        ('LightGBM', 300, 4)) v(model, w, model_rank)
),
scored AS (
  SELECT m.model, m.model_rank, t.transaction_id, t.is_fraud AS label,
         CAST(CAST(('0x' || substr(md5(t.transaction_id || m.model), 1, 8)) AS BIGINT) % 1000 + m.w * t.is_fraud
              AS DOUBLE) / CAST(1000 + m.w AS DOUBLE) AS score
  FROM txn t, models m
),
scored2 AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS prediction FROM scored),
counts AS (
  SELECT model, model_rank,
         count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
         count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
         count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp
  FROM scored2 GROUP BY 1, 2
),
rep0 AS (
  SELECT model, model_rank,
    CASE WHEN tn + fn = 0 THEN 0.0 ELSE CAST(tn AS DOUBLE) / CAST(tn + fn AS DOUBLE) END AS precision_class_0,
    CASE WHEN tn + fp = 0 THEN 0.0 ELSE CAST(tn AS DOUBLE) / CAST(tn + fp AS DOUBLE) END AS recall_class_0,
    CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END AS precision_class_1,
    CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) END AS recall_class_1,
    CAST(tn + fp AS BIGINT) AS support_class_0, CAST(tp + fn AS BIGINT) AS support_class_1,
    CASE WHEN tn + fp + fn + tp = 0 THEN 0.0
         ELSE CAST(tp + tn AS DOUBLE) / CAST(tn + fp + fn + tp AS DOUBLE) END AS accuracy
  FROM counts
),
rep1 AS (
  SELECT *,
    CASE WHEN precision_class_0 + recall_class_0 = 0 THEN 0.0
         ELSE CAST(2 AS DOUBLE) * precision_class_0 * recall_class_0 / (precision_class_0 + recall_class_0)
         END AS f1_score_class_0,
    CASE WHEN precision_class_1 + recall_class_1 = 0 THEN 0.0
         ELSE CAST(2 AS DOUBLE) * precision_class_1 * recall_class_1 / (precision_class_1 + recall_class_1)
         END AS f1_score_class_1,
    CAST(support_class_0 + support_class_1 AS DOUBLE) AS n
  FROM rep0
),
report AS (
  SELECT model, model_rank, precision_class_0, recall_class_0, precision_class_1, recall_class_1,
    support_class_0, support_class_1, accuracy, f1_score_class_0, f1_score_class_1,
    (precision_class_0 + precision_class_1) / 2 AS macro_avg_precision,
    CASE WHEN n = 0 THEN 0.0 ELSE (precision_class_0 * CAST(support_class_0 AS DOUBLE)
         + precision_class_1 * CAST(support_class_1 AS DOUBLE)) / n END AS weighted_avg_precision,
    (recall_class_0 + recall_class_1) / 2 AS macro_avg_recall,
    CASE WHEN n = 0 THEN 0.0 ELSE (recall_class_0 * CAST(support_class_0 AS DOUBLE)
         + recall_class_1 * CAST(support_class_1 AS DOUBLE)) / n END AS weighted_avg_recall,
    (f1_score_class_0 + f1_score_class_1) / 2 AS macro_avg_f1_score,
    CASE WHEN n = 0 THEN 0.0 ELSE (f1_score_class_0 * CAST(support_class_0 AS DOUBLE)
         + f1_score_class_1 * CAST(support_class_1 AS DOUBLE)) / n END AS weighted_avg_f1_score
  FROM rep1
),
by_score AS (
  SELECT model, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
  FROM scored2 GROUP BY 1, 2
),
auc AS (
  SELECT model,
    CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
      CAST(sum(CAST(pos AS DECIMAL(38,0)) * CAST(cn - neg AS DECIMAL(38,0)) * 2
               + CAST(pos AS DECIMAL(38,0)) * CAST(neg AS DECIMAL(38,0))) AS DOUBLE)
      / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE) * 2) END AS roc_auc
  FROM (SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY score ROWS UNBOUNDED PRECEDING) AS cn
        FROM by_score) x
  GROUP BY 1
),
ap AS (
  SELECT model,
    CASE WHEN sum(pos) > 0 THEN round(sum(CAST(pos AS DOUBLE) * (cp / (cp + cn))) / sum(pos), 10) END AS auc_pr
  FROM (SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cp,
                  sum(neg) OVER (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cn
        FROM by_score) x
  GROUP BY 1
),
model_metrics AS (
  SELECT r.* EXCLUDE (model_rank), r.model_rank, auc.roc_auc, ap.auc_pr
  FROM report r JOIN auc USING (model) JOIN ap USING (model)
)"""

_SPLIT = "CASE WHEN CAST(('0x' || substr(md5(transaction_id || '42'), 1, 8)) AS BIGINT) % 10000 < 2000 " \
         "THEN 'test' ELSE 'train' END"


def with_scored(body: str) -> str:
    return "WITH " + TXN_CTE.strip() + _SCORED_CTE + "\n" + body.strip()


ORACLE.update({
    "model_metrics": with_scored("SELECT * EXCLUDE (model_rank) FROM model_metrics"),
    "best_model": with_scored("""
SELECT model, f1_score_class_1 FROM model_metrics ORDER BY f1_score_class_1 DESC NULLS LAST, model_rank LIMIT 1"""),
    "confusion_matrix": with_scored("""
SELECT model, label, prediction, CAST(count(*) AS BIGINT) AS count FROM scored2 GROUP BY 1, 2, 3"""),
    "label_distribution": with_txn("""
SELECT is_fraud AS label, CAST(count(*) AS BIGINT) AS count, count(*) / sum(count(*)) OVER () AS share
FROM txn GROUP BY 1"""),
    "class_balance": with_txn("""
SELECT CAST(count(*) FILTER (WHERE is_fraud = 0) AS BIGINT) AS n_class_0,
       CAST(count(*) FILTER (WHERE is_fraud = 1) AS BIGINT) AS n_class_1,
       CASE WHEN count(*) FILTER (WHERE is_fraud = 0) > 0 AND count(*) FILTER (WHERE is_fraud = 1) > 0
            THEN count(*) FILTER (WHERE is_fraud = 0) / count(*) FILTER (WHERE is_fraud = 1) END AS imbalance_ratio,
       CASE WHEN count(*) FILTER (WHERE is_fraud = 0) > 0
            THEN count(*) / (count(*) FILTER (WHERE is_fraud = 0) * 2) END AS weight_class_0,
       CASE WHEN count(*) FILTER (WHERE is_fraud = 1) > 0
            THEN count(*) / (count(*) FILTER (WHERE is_fraud = 1) * 2) END AS weight_class_1
FROM txn"""),
    "train_test_split": with_txn(f"""
SELECT {_SPLIT} AS split, is_fraud AS label, CAST(count(*) AS BIGINT) AS rows FROM txn GROUP BY 1, 2"""),
    "undersampled_train": with_txn(f"""
, train AS (SELECT transaction_id, is_fraud AS label FROM txn WHERE {_SPLIT} = 'train'),
cnt AS (SELECT count(*) FILTER (WHERE label = 0) AS n0, count(*) FILTER (WHERE label = 1) AS n1 FROM train),
maj AS (SELECT CASE WHEN n0 > n1 THEN 0 ELSE 1 END AS m, least(n0, n1) AS k FROM cnt),
ranked AS (
  SELECT t.*, row_number() OVER (ORDER BY CAST(('0x' || substr(md5(transaction_id || '42'), 1, 8)) AS BIGINT),
                                          transaction_id) AS rn
  FROM train t WHERE label = (SELECT m FROM maj)
)
SELECT transaction_id, label FROM train WHERE label <> (SELECT m FROM maj)
UNION ALL
SELECT transaction_id, label FROM ranked WHERE rn <= (SELECT k FROM maj)""").replace("\n, train AS", ",\ntrain AS"),
})


# --- JSON landing scan and streaming ingest ----------------------------------------

ORACLE.update({
    "landing_scan": with_txn("""
SELECT transaction_id, customer_id, amount, currency, is_fraud, transaction_type, merchant_id, latitude,
       loyalty_points, fraud_rules
FROM stg"""),
    "streamed_landing": ORACLE["landed_transactions"],
    "stream_window_counts": with_messages("""
, win AS (
  SELECT time_bucket(INTERVAL '30 days', kafka_timestamp, TIMESTAMP '1970-01-01 00:00:00') AS window_start, *
  FROM validated
)
SELECT window_start, window_start + INTERVAL '30 days' AS window_end,
       CAST(count(*) AS BIGINT) AS total,
       CAST(count(*) FILTER (WHERE status = 'valid') AS BIGINT) AS valid,
       CAST(count(*) FILTER (WHERE status = 'malformed') AS BIGINT) AS invalid_json,
       CAST(count(*) FILTER (WHERE status = 'invalid') AS BIGINT) AS invalid_data,
       CAST(count(*) FILTER (WHERE status = 'tombstone') AS BIGINT) AS tombstones,
       CAST(count(*) FILTER (WHERE status = 'valid' AND TRY_CAST(json_extract_string(js, '$.is_fraud') AS DOUBLE) = 1
                              OR status = 'valid' AND json_extract_string(js, '$.is_fraud') = 'true') AS BIGINT)
         AS fraud
FROM win
GROUP BY 1
""").replace("\n, win AS", ",\nwin AS"),
})
