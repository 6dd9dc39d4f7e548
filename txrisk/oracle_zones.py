"""Independent DuckDB SQL for the queries over the batch zones (``txrisk.plans.zone_queries``)."""

from __future__ import annotations

from txrisk.oracle import with_messages, with_txn

_AMOUNT = """CASE json_type(js, '$.amount') WHEN 'BOOLEAN' THEN CAST(json_extract_string(js, '$.amount') = 'true' AS DOUBLE)
            ELSE TRY_CAST(json_extract_string(js, '$.amount') AS DOUBLE) END"""
_LABEL = """CASE json_type(js, '$.is_fraud') WHEN 'BOOLEAN' THEN CAST(json_extract_string(js, '$.is_fraud') = 'true' AS INTEGER)
            ELSE CAST(TRY_CAST(json_extract_string(js, '$.is_fraud') AS DOUBLE) AS INTEGER) END"""
_TIME = """CASE f WHEN 41 THEN TIMESTAMP '2025-03-01 10:15:00' WHEN 42 THEN TIMESTAMP '2025-03-08 04:45:00.123456'
              ELSE CAST(regexp_replace(json_extract_string(js, '$.timestamp'), 'Z$', '') AS TIMESTAMP) END"""

_KINDS = """
buckets AS (
  SELECT CASE k % 997 WHEN 2 THEN 'object' WHEN 3 THEN 'broken' WHEN 4 THEN 'blank'
              ELSE CASE WHEN k % 2 = 0 THEN 'lines' ELSE 'array' END END AS kind,
         CASE WHEN k % 997 IN (2, 3, 4) THEN k ELSE k // 50000 END AS bucket, transaction_id, amount, customer_id, is_fraud
  FROM (SELECT *, CAST(substr(transaction_id, 3) AS BIGINT) AS k FROM txn)
)"""

ORACLE: dict[str, str] = {
    "landed_documents": with_messages(f"""
SELECT json_extract_string(js, '$.transaction_id') AS transaction_id, {_AMOUNT} AS amount, {_LABEL} AS is_fraud,
       TRY_CAST(json_extract_string(js, '$.customer_age') AS INTEGER) AS customer_age,
       CASE WHEN json_type(js, '$.customer_age') = 'VARCHAR' THEN CAST(json_extract(js, '$.customer_age') AS VARCHAR) END AS customer_age__raw,
       TRY_CAST(json_extract_string(js, '$.loyalty_points') AS INTEGER) AS loyalty_points,
       CASE WHEN json_type(js, '$.loyalty_points') = 'ARRAY' THEN CAST(json_extract(js, '$.loyalty_points') AS VARCHAR) END AS loyalty_points__raw,
       json_extract_string(js, '$.note') AS note, json_extract_string(js, '$.channel.app') AS channel_app,
       CAST(json_extract_string(js, '$.channel.v') AS BIGINT) AS channel_v
FROM validated WHERE status = 'valid'"""),
    "extra_field_counts": with_messages("""
SELECT field, type, CAST(count(*) AS BIGINT) AS records FROM (
  SELECT 'note' AS field, 'STRING' AS type FROM validated WHERE status = 'valid' AND json_type(js, '$.note') = 'VARCHAR'
  UNION ALL SELECT 'channel', 'OBJECT<app: STRING, v: BIGINT>' FROM validated WHERE status = 'valid' AND json_type(js, '$.channel') = 'OBJECT'
  UNION ALL SELECT 'customer_age', 'STRING' FROM validated WHERE status = 'valid' AND json_type(js, '$.customer_age') = 'VARCHAR'
  UNION ALL SELECT 'loyalty_points', 'ARRAY<BIGINT>' FROM validated WHERE status = 'valid' AND json_type(js, '$.loyalty_points') = 'ARRAY'
) GROUP BY field, type"""),
    "sandbox_zone": with_messages(f"""
SELECT json_extract_string(js, '$.transaction_id') AS transaction_id, {_AMOUNT} AS amount, {_TIME} AS "timestamp",
       CAST({_LABEL} AS BOOLEAN) AS is_fraud, json_extract_string(js, '$.merchant_id') AS merchant_id,
       coalesce({_AMOUNT} > 1000, false) AS is_large_transaction, true AS stamped, dayname({_TIME}) AS day, 0::BIGINT AS transport_columns
FROM validated WHERE status = 'valid'"""),
    "zone_reconciliation": with_messages("""
SELECT n AS consolidated, 0::BIGINT AS bad_files, n AS input_rows, n AS output_rows, true AS ok, 0::BIGINT AS rejected_amount,
       0::BIGINT AS rejected_timestamp, 0::BIGINT AS rejected_is_fraud, 0::BIGINT AS rejected_transaction_id, 0::BIGINT AS rejected_merchant_id,
       n AS copied
FROM (SELECT CAST(count(*) AS BIGINT) AS n FROM validated WHERE status = 'valid')"""),
    "landing_report": with_txn(f"""
,{_KINDS}
SELECT kind, CASE kind WHEN 'broken' THEN 'bad' WHEN 'blank' THEN 'empty' ELSE 'good' END AS status,
       CAST(count(DISTINCT bucket) AS BIGINT) AS files, CAST(CASE WHEN kind IN ('broken', 'blank') THEN 0 ELSE count(*) END AS BIGINT) AS records
FROM buckets GROUP BY kind""").replace("\n,\nbuckets", ",\nbuckets"),
    "merged_documents": with_txn(f"""
,{_KINDS}
SELECT transaction_id, amount, customer_id, is_fraud FROM buckets WHERE kind NOT IN ('broken', 'blank')""").replace("\n,\nbuckets", ",\nbuckets"),
    "fallback_ids": with_messages("""
SELECT CAST(epoch_ms(kafka_timestamp) AS BIGINT) AS millis, CAST(count(*) AS BIGINT) AS messages, CAST(count(DISTINCT js) AS BIGINT) AS ids
FROM validated
WHERE status = 'invalid' AND json_type(js) = 'OBJECT' AND coalesce(json_extract_string(js, '$.transaction_id'), '') = '' GROUP BY 1"""),
    "labelled_messages": with_messages(f"""
SELECT "offset", is_fraud, coalesce(amount <= 0 AND type NOT IN ('refund', 'reversal'), false) AS amount_quality_issue
FROM (SELECT "offset", {_LABEL} AS is_fraud, {_AMOUNT} AS amount, json_extract_string(js, '$.transaction_type') AS type
      FROM validated WHERE status IN ('valid', 'invalid') AND json_type(js) = 'OBJECT')
WHERE is_fraud IN (0, 1)"""),
    "lossy_text": with_messages("""
SELECT CASE WHEN value IS NULL THEN 'tombstone' ELSE 'malformed' END AS status, CAST(count(*) AS BIGINT) AS messages,
       CAST(count(value) AS BIGINT) AS replaced
FROM validated GROUP BY 1"""),
}
