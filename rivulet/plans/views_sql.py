"""The topic views of :mod:`rivulet.sources.tables`, written as SQL CTEs for the
DuckDB oracle.  ``with_views("...", "env_events")`` prefixes a query with the
CTEs it names."""

from __future__ import annotations

VIEWS = {
    "env_events": """env_events AS (
  SELECT event_type AS "key",
         CAST(user_id AS VARCHAR) || chr(9) || event_type || ' ' || props AS "value",
         CAST(user_id % 4 AS INTEGER) AS "partition",
         CAST(row_number() OVER (PARTITION BY user_id % 4 ORDER BY ts, event_id) - 1 AS BIGINT) AS "offset",
         ts AS "timestamp"
  FROM events)""",
    # needs env_events
    "env_dirty": """env_dirty AS (
  SELECT CASE WHEN "offset" % 11 <> 3 THEN "key" END AS "key",
         CASE WHEN "offset" % 13 = 5 OR ("key" = 'signup' AND "timestamp" >= TIMESTAMP '2024-01-20') THEN NULL
              WHEN "offset" % 7 = 2 THEN 'NULL' || chr(9) || "value" ELSE "value" END AS "value",
         "partition", "offset", "timestamp"
  FROM env_events)""",
    "env_docs": """env_docs AS (
  SELECT lang AS "key", text AS "value", CAST(doc_id % 4 AS INTEGER) AS "partition",
         CAST(row_number() OVER (PARTITION BY doc_id % 4 ORDER BY doc_id) - 1 AS BIGINT) AS "offset",
         CAST(NULL AS TIMESTAMP) AS "timestamp"
  FROM documents)""",
    "env_turns": """env_turns AS (
  SELECT role AS "key", text AS "value", CAST(conv_id % 4 AS INTEGER) AS "partition",
         CAST(row_number() OVER (PARTITION BY conv_id % 4 ORDER BY conv_id, turn) - 1 AS BIGINT) AS "offset",
         CAST(NULL AS TIMESTAMP) AS "timestamp"
  FROM conversations)""",
    "live_input": """live_input AS (
  SELECT event_type AS series, ts, event_id,
         CASE event_id % 10 WHEN 0 THEN 'bad' || event_type
                            WHEN 1 THEN CAST(value AS VARCHAR)
                            WHEN 2 THEN ' +1_000 '
                            ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS text
  FROM events)""",
    "gauge_input": """gauge_input AS (
  SELECT event_type AS category, ts, event_id, CAST(floor(value) AS BIGINT) AS value
  FROM events)""",
    "wide_input": """wide_input AS (
  SELECT ts AS time, event_id, CAST(user_id * 1.0 AS DOUBLE) AS cpu,
         CAST(value AS DOUBLE) AS memory,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS disk
  FROM events)""",
}


def with_views(body: str, *names: str, extra: dict | None = None) -> str:
    ctes = [VIEWS[n] for n in names] + [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    if not ctes:
        return body
    if body.lstrip().upper().startswith("WITH "):
        # merge with the body's own CTE list
        return "WITH " + ",\n".join(ctes) + ",\n" + body.lstrip()[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
