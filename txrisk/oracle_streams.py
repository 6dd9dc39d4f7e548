"""Independent DuckDB SQL for the streaming queries (``txrisk.plans.stream_queries``): what one batch over the topic gives."""

from __future__ import annotations

from txrisk.oracle import with_messages

_OUTCOME = with_messages("""
SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE status = 'valid') AS BIGINT) AS valid,
       CAST(count(*) FILTER (WHERE status = 'malformed') AS BIGINT) AS invalid_json,
       CAST(count(*) FILTER (WHERE status = 'invalid') AS BIGINT) AS invalid_data,
       CAST(count(*) FILTER (WHERE status = 'tombstone') AS BIGINT) AS tombstones,
       CAST(count(DISTINCT CASE WHEN status = 'valid' THEN json_extract_string(js, '$.transaction_id') END) AS BIGINT) AS landed,
       CAST(count(*) FILTER (WHERE status IN ('malformed', 'invalid')) AS BIGINT) AS dead_letters
FROM validated""")

ORACLE: dict[str, str] = {
    "stream_deduplicated": _OUTCOME,
    "stream_recovered": _OUTCOME,
    "stream_progress": with_messages("""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS observed_rows,
       CAST(count(*) FILTER (WHERE value IS NULL) AS BIGINT) AS tombstones, CAST(sum(strlen(value)) AS BIGINT) AS bytes,
       true AS one_row_per_batch
FROM validated"""),
}
