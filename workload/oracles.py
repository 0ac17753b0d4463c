"""The same answers as plain SQL over the test tables."""

from __future__ import annotations

from workload.queries import AS_OF, COARSE_FROM, COARSE_TO, FROM_DAY, FROM_TS, NOW, REPOS, SLICE_DAY, SLICE_HOUR, SPLIT, TO_DAY, TO_TS, TYPES

_BASE = """
base AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    CASE event_type WHEN 'click' THEN 'WatchEvent' WHEN 'view' THEN 'PushEvent'
      WHEN 'purchase' THEN 'IssuesEvent' WHEN 'signup' THEN 'CreateEvent'
      WHEN 'error' THEN 'PullRequestEvent' END AS type
  FROM events),
lake AS (
  SELECT CAST(event_id AS VARCHAR) AS id, type, ts AS created_at, user_id % 2 = 0 AS public,
    CASE WHEN user_id % 29 <> 0 THEN 'u' || user_id END AS actor_login,
    CASE WHEN user_id % 29 <> 0 AND user_id % 5 <> 0 THEN 'u' || user_id END AS actor_display_login,
    CAST(k AS VARCHAR) AS repo_id, 'repo/' || k AS repo_name,
    CASE WHEN user_id % 3 <> 0 THEN 'org' || user_id % 10 END AS org_login,
    '{' || CASE WHEN k % 7 = 0 THEN '' ELSE '"action":"' ||
      CASE k % 3 WHEN 0 THEN 'opened' WHEN 1 THEN 'closed' ELSE 'started' END || '",' END
      || '"ref":"refs/heads/b' || k || '","ref_type":"'
      || CASE WHEN k % 2 = 0 THEN 'branch' ELSE 'tag' END || '","number":' || k || '}' AS payload,
    CASE WHEN type IN ('WatchEvent', 'IssuesEvent', 'PullRequestEvent') AND k % 7 <> 0 THEN
      CASE k % 3 WHEN 0 THEN 'opened' WHEN 1 THEN 'closed' ELSE 'started' END END AS action,
    CASE WHEN type IN ('PushEvent', 'CreateEvent') THEN 'refs/heads/b' || k END AS ref,
    CASE WHEN type = 'CreateEvent' THEN CASE WHEN k % 2 = 0 THEN 'branch' ELSE 'tag' END END AS ref_type,
    CASE WHEN type IN ('IssuesEvent', 'PullRequestEvent') THEN CAST(k AS INTEGER) END AS number
  FROM base),
serving AS (
  SELECT type AS event_type, actor_login, repo_name, date_trunc('milliseconds', created_at) AS created_at, action
  FROM lake),
days AS (
  SELECT CAST(created_at AS DATE) AS date, event_type, repo_name, COUNT(*) AS cnt,
    COUNT(DISTINCT actor_login) AS actors
  FROM serving GROUP BY ALL),
members AS (
  SELECT DISTINCT CAST(created_at AS DATE) AS date, event_type, repo_name, actor_login
  FROM serving WHERE actor_login IS NOT NULL),
messages AS (
  SELECT CASE WHEN user_id <> 7 THEN CAST(user_id AS INTEGER) END AS user_id,
    date_trunc('milliseconds', ts) AS timestamp, event_type
  FROM events WHERE user_id NOT IN (11, 13)),
message_text AS (
  SELECT user_id, CASE WHEN user_id = 13 THEN '!' || event_type ELSE
    '{"user_id":' || CASE WHEN user_id = 7 THEN 3000000000 ELSE user_id END
    || ',"ts":"' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '"'
    || CASE WHEN user_id = 11 THEN '' ELSE ',"event_type":"' || event_type || '"' END || '}' END AS value
  FROM events),
minutes AS (
  SELECT date_trunc('minute', timestamp) AS minute, event_type, COUNT(*) AS count
  FROM messages GROUP BY ALL),
draws AS (SELECT event_id, CAST(CAST(event_id % 4294967296 AS HUGEINT) * 2654435761 % 4294967296 AS BIGINT) AS r FROM events)
"""

_HOUR_START = f"TIMESTAMP '{SLICE_DAY} {SLICE_HOUR:02d}:00:00'"
_IN_HOUR = f"(created_at >= {_HOUR_START} AND created_at < {_HOUR_START} + INTERVAL 1 HOUR)"
_IN_DAY = f"(CAST(created_at AS DATE) = DATE '{SLICE_DAY}')"
_IN_RANGE = f"created_at > TIMESTAMP '{FROM_TS}' AND created_at <= TIMESTAMP '{TO_TS}'"
_IN_DAYS = f"date BETWEEN DATE '{FROM_DAY}' AND DATE '{TO_DAY}'"
_HISTORIC = "created_at <= TIMESTAMP '2024-01-20 00:00:00'"
_RECENT = "created_at > TIMESTAMP '2024-01-15 00:00:00'"
_SERVING = "event_type, actor_login, repo_name, created_at, action"


def _in(values) -> str:
    return "(" + ", ".join(f"'{value}'" for value in values) + ")"


def _from_lake(condition: str) -> str:
    """Serving rows of the lake rows that meet a condition on the full-precision time."""
    return (
        "SELECT type AS event_type, actor_login, repo_name, "
        f"date_trunc('milliseconds', created_at) AS created_at, action FROM lake WHERE {condition}"
    )


def _top(keys: str, limit: int = 10, extra: str = "") -> str:
    return (
        f"SELECT {keys}, CAST(SUM(cnt) AS BIGINT) AS count FROM days WHERE {_IN_DAYS} {extra} "
        f"GROUP BY {keys} ORDER BY count DESC, {keys} LIMIT {limit}"
    )


_REPLACED_COLUMNS = "* REPLACE ('replaced' AS action)"

_BACKFILL = (
    "SELECT CAST(user_id AS INTEGER) AS user_id, date_trunc('milliseconds', ts) AS timestamp, event_type "
    f"FROM events WHERE ts BETWEEN TIMESTAMP '{FROM_TS}' AND TIMESTAMP '{TO_TS}'"
)

_TWO_SOURCES = (
    f"SELECT CAST(created_at AS DATE) AS date, event_type, repo_name, COUNT(*) AS count, "
    f"COUNT(DISTINCT actor_login) AS actor_count FROM (SELECT * FROM serving WHERE {_HISTORIC} "
    f"UNION ALL SELECT * FROM serving WHERE {_RECENT}) GROUP BY ALL"
)

_SQL = {
    "scan_archive_json": "SELECT id, type, strftime(created_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS created_at, public, actor_login FROM lake",
    "scan_archive_day": "SELECT id, date_trunc('hour', created_at) AS archive_hour FROM lake",
    "scan_lake_range": f"SELECT * FROM lake WHERE created_at BETWEEN TIMESTAMP '{FROM_TS}' AND TIMESTAMP '{TO_TS}'",
    "stream_source_events": "SELECT value FROM message_text",
    "decode_json_message": "SELECT * FROM messages",
    "reject_json_message": "SELECT value FROM message_text WHERE user_id IN (11, 13)",
    "scan_ndjson_items": "SELECT 'id_' || (1000 + r % 9000) AS id, 'Item ' || r % 100 AS name, CAST(r % 1000 + r AS BIGINT) AS value, TIMESTAMP '2025-05-20 11:07:38' - to_seconds(r % 2592000) AS timestamp FROM draws",
    "gen_items": "SELECT 'id_' || (1000 + r % 9000) AS id, 'Item ' || r % 100 AS name, CAST(r % 1000 + r AS BIGINT) AS value, TIMESTAMP '2025-05-20 11:07:38' - to_seconds(r % 2592000) AS timestamp FROM draws",
    "gen_items_copy": "SELECT 'id_' || r % 10000 AS id, 'name_' || r % 1000 AS name, CAST(r * 100 AS BIGINT) AS value, TIMESTAMP '2025-05-20 11:07:38' - to_seconds(r % 2592000) AS timestamp FROM (SELECT (r + 17) % 4294967296 AS r FROM draws)",
    "project_serving": "SELECT * FROM serving",
    "parse_created_at": "SELECT id, created_at FROM lake",
    "derive_action": "SELECT id, type, action FROM lake",
    "derive_ref": "SELECT id, type, ref FROM lake",
    "derive_ref_type": "SELECT id, type, ref_type FROM lake",
    "derive_number": "SELECT id, type, number FROM lake",
    "payload_as_json": "SELECT id, payload FROM lake",
    "conform_to_lake": "SELECT * FROM lake",
    "trunc_millis": "SELECT event_id, date_trunc('milliseconds', ts) AS created_at FROM events",
    "require_not_null": "SELECT * FROM serving WHERE event_type <> 'PushEvent'",
    "default_empty": "SELECT event_type, coalesce(actor_login, '') AS actor_login, coalesce(repo_name, '') AS repo_name, created_at, action FROM serving",
    "copy_historic": _from_lake(_IN_RANGE),
    "copy_rt_range": _from_lake(_IN_RANGE),
    "copy_rt_incremental": _from_lake(
        "date_trunc('milliseconds', created_at) > (SELECT MAX(last_date) FROM ("
        f"SELECT MAX(created_at) AS last_date FROM serving WHERE created_at <= TIMESTAMP '{SPLIT}' UNION ALL "
        f"SELECT MAX(created_at) FROM serving WHERE created_at >= TIMESTAMP '{SPLIT}' AND created_at < TIMESTAMP '2024-01-22 00:00:00' UNION ALL "
        f"SELECT TIMESTAMP '{NOW}' - INTERVAL 1 MONTH))"
    ),
    "backfill_range": _BACKFILL,
    "backfill_tiled": _from_lake(
        f"created_at > TIMESTAMP '{FROM_DAY} 00:00:00' AND created_at <= TIMESTAMP '{TO_DAY} 00:00:00' + INTERVAL 1 DAY"
    ),
    "slice_hour": f"SELECT * FROM lake WHERE strftime(created_at, '%Y-%m-%d') = '{SLICE_DAY}' AND hour(created_at) = {SLICE_HOUR}",
    "slice_day": f"SELECT * FROM lake WHERE strftime(created_at, '%Y-%m-%d') = '{SLICE_DAY}'",
    "slice_count": f"SELECT COUNT(*) AS rows FROM lake WHERE strftime(created_at, '%Y-%m-%d') = '{SLICE_DAY}'",
    "retain_one_month": f"SELECT * FROM serving WHERE CAST(created_at AS DATE) + INTERVAL 1 MONTH > TIMESTAMP '{AS_OF}'",
    "rollup_day_count": "SELECT date, event_type, repo_name, cnt, 'historic' AS source FROM days",
    "rollup_day_actors": "SELECT *, 'historic' AS source FROM members",
    "merge_count": "SELECT event_type, repo_name, COUNT(*) AS count FROM serving GROUP BY ALL",
    "merge_actors_by_type": "SELECT event_type, COUNT(DISTINCT actor_login) AS actor_count FROM serving GROUP BY ALL",
    "merge_actors_by_day": "SELECT CAST(created_at AS DATE) AS date, event_type, COUNT(DISTINCT actor_login) AS actor_count FROM serving WHERE actor_login IS NOT NULL GROUP BY ALL",
    "rollup_two_sources": _TWO_SOURCES,
    "rollup_evolved": f"SELECT date, event_type, repo_name, cnt AS count, CASE WHEN date >= DATE '{SPLIT[:10]}' THEN actors ELSE 0 END AS actor_count FROM days",
    "rollup_minute_count": "SELECT minute, event_type, count AS cnt FROM minutes",
    "write_rollup_day": "SELECT date, event_type, repo_name, cnt, 'historic' AS source, CAST(year(date) * 100 + month(date) AS INTEGER) AS month FROM days",
    "write_rollup_members": "SELECT *, 'historic' AS source, CAST(year(date) * 100 + month(date) AS INTEGER) AS month FROM members",
    "top_repos_by_type": _top("event_type"),
    "top_repos_by_repo": _top("repo_name"),
    "top_repos_by_repo_type": _top("repo_name, event_type", 25),
    "top_repos_window": _top("date", 100),
    "top_repos_filtered": _top("repo_name", 10, f"AND repo_name IN {_in(REPOS)} AND event_type IN {_in(TYPES)}"),
    "top_repos_total": f"SELECT CAST(coalesce(SUM(cnt), 0) AS BIGINT) AS count FROM days WHERE {_IN_DAYS}",
    "top_repos_default_window": "SELECT CAST(coalesce(SUM(cnt), 0) AS BIGINT) AS count FROM days WHERE date BETWEEN DATE '2025-04-12' AND DATE '2025-05-16'",
    "events_stats": f"SELECT * FROM minutes WHERE minute >= TIMESTAMP '{FROM_TS}' AND minute <= TIMESTAMP '{TO_TS}' ORDER BY count DESC",
    "last_event_date": f"SELECT MAX(d) AS last_date FROM (SELECT MAX(created_at) AS d FROM serving UNION ALL SELECT TIMESTAMP '{NOW}' - INTERVAL 1 MONTH)",
    "last_event_date_floor": "SELECT MAX(d) AS last_date FROM (SELECT MAX(created_at) AS d FROM serving UNION ALL SELECT TIMESTAMP '2024-03-31 10:00:00' - INTERVAL 1 MONTH)",
    "pending_hours": f"SELECT unnest(range(date_trunc('hour', last) + INTERVAL 1 HOUR, date_trunc('hour', TIMESTAMP '{NOW}'), INTERVAL 1 HOUR)) AS hour FROM (SELECT MAX(created_at) AS last FROM serving WHERE {_HISTORIC})",
    "pending_hours_range": "SELECT unnest(range(date_trunc('hour', MIN(ts)), date_trunc('hour', MAX(ts)), INTERVAL 1 HOUR)) AS hour FROM events",
    "missing_hours": "WITH loaded AS (SELECT DISTINCT date_trunc('hour', created_at) AS hour FROM serving WHERE (day(created_at) * 24 + hour(created_at)) % 7 <> 3) SELECT hour FROM (SELECT unnest(generate_series(MIN(hour), MAX(hour), INTERVAL 1 HOUR)) AS hour FROM loaded) WHERE hour NOT IN (SELECT hour FROM loaded)",
    "plan_loads": "SELECT hour, strftime(hour, '%Y-%m-%d') || '-' || hour(hour) || '.json.gz' AS archive FROM (SELECT unnest(range(date_trunc('hour', MIN(ts)), date_trunc('hour', MAX(ts)), INTERVAL 1 HOUR)) AS hour FROM events)",
    "scalar_battery": """SELECT event_id, CAST(ts AS DATE) AS date, date_trunc('minute', ts) AS minute, date_trunc('hour', ts) AS hour_start,
      date_trunc('milliseconds', ts) AS millis, CAST(year(ts) * 100 + month(ts) AS INTEGER) AS yyyymm,
      CAST(date_trunc('month', ts) AS DATE) AS month_start, CAST(hour(ts) AS INTEGER) AS hour, strftime(ts, '%Y-%m-%d') AS date_text,
      CAST(CAST(ts AS DATE) + INTERVAL 1 MONTH AS DATE) AS month_later, ts - INTERVAL 1 MONTH AS month_earlier,
      ts - to_seconds(event_id % 86400) AS seconds_earlier, 'id_' || (1000 + event_id % 9000) AS label,
      CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    "write_clustered": "SELECT *, CAST(created_at AS DATE) AS event_date FROM serving",
    "drop_expired_days": f"SELECT * FROM serving WHERE CAST(created_at AS DATE) + INTERVAL 1 MONTH > TIMESTAMP '{AS_OF}'",
    "append_events": "SELECT * FROM lake",
    "replace_hour": f"SELECT * FROM lake WHERE NOT {_IN_HOUR} UNION ALL SELECT {_REPLACED_COLUMNS} FROM lake WHERE {_IN_HOUR} AND type <> 'PushEvent'",
    "replace_day": f"SELECT * FROM lake WHERE NOT {_IN_DAY} UNION ALL SELECT {_REPLACED_COLUMNS} FROM lake WHERE {_IN_DAY} AND hour(created_at) >= 12",
    "load_hour": "SELECT * FROM lake",
    "load_day": "SELECT * FROM lake",
    "load_range": "SELECT * FROM lake",
    "load_pending": "SELECT * FROM lake",
    "load_partial_landing": "SELECT * FROM lake",
    "append_rt_twice": "SELECT CAST(created_at AS DATE) AS date, COUNT(*) AS rows, COUNT(*) AS count FROM serving GROUP BY ALL",
    "backfill_minute_rollup": f"SELECT date_trunc('minute', timestamp) AS minute, event_type, COUNT(*) AS count FROM (SELECT * FROM messages UNION ALL {_BACKFILL}) GROUP BY ALL",
    "copy_to_rollup": f"SELECT CAST(created_at AS DATE) AS date, type AS event_type, repo_name, COUNT(*) AS count, COUNT(DISTINCT actor_login) AS actor_count FROM lake WHERE {_IN_RANGE} GROUP BY ALL",
    "compact_day": "SELECT date, event_type, repo_name, cnt AS count, actors AS actor_count FROM days",
    "load_report": "SELECT date_trunc('hour', created_at) AS archive_hour, COUNT(*) AS rows FROM lake GROUP BY ALL",
    "compact_minute": "SELECT * FROM minutes",
    "stream_ingest": "SELECT * FROM messages",
    "stream_rejects": "SELECT value FROM message_text WHERE user_id IN (11, 13)",
    "stream_minute_rollup": "SELECT * FROM minutes",
    "stream_late_rows": "SELECT * FROM minutes",
    "stream_day_rollup": _TWO_SOURCES,
    "stream_plus_backfill": f"SELECT * FROM messages UNION ALL {_BACKFILL}",
}


_SQL["load_distant_edge"] = _SQL["load_missing"] = "SELECT * FROM lake"
_SQL["load_ledger"] = "SELECT date_trunc('hour', created_at) AS archive_hour, COUNT(*) AS rows, CAST(0 AS BIGINT) AS rejects FROM lake GROUP BY ALL"
_UPTO = ", ".join(f"COUNT(*) FILTER (minute(created_at) % 4 <= {i}) AS upto_{i}" for i in range(4))
_SQL["compact_while_reading"] = f"""SELECT * FROM (SELECT event_type, COUNT(*) AS count, {_UPTO} FROM serving GROUP BY event_type)
  JOIN (SELECT event_type, CAST(SUM(actors) AS BIGINT) AS actor_days FROM days GROUP BY event_type) USING (event_type)"""
_COPIED = f"""SELECT CAST(created_at AS DATE) AS date, type AS event_type, COUNT(*) AS rows, COUNT(*) AS count,
  COUNT(DISTINCT actor_login) AS actor_count FROM lake WHERE {_IN_RANGE} GROUP BY ALL"""
_SQL["append_historic_twice"] = _SQL["append_retry_after_compaction"] = _COPIED
_SQL["merge_actors_bitmap"] = _SQL["merge_actors_by_type"]
_SQL["merge_actors_bitmap_by_day"] = _SQL["merge_actors_by_day"]
_SQL["top_repos_coarse"] = f"""SELECT repo_name, CAST(SUM(cnt) AS BIGINT) AS count FROM days
  WHERE date BETWEEN DATE '{COARSE_FROM}' AND DATE '{COARSE_TO}' GROUP BY repo_name ORDER BY count DESC, repo_name LIMIT 50"""
_SQL["top_repos_coarse_total"] = f"SELECT CAST(coalesce(SUM(cnt), 0) AS BIGINT) AS count FROM days WHERE event_type IN {_in(TYPES)}"
_SQL["rollup_evolved_stored"] = f"""SELECT date, event_type, repo_name, cnt AS count,
  CASE WHEN date >= DATE '{FROM_DAY}' THEN actors ELSE 0 END AS actor_count FROM days"""
_SQL["derive_from_variant"] = "SELECT id, type, action, ref, ref_type, number FROM lake"
_SQL["stream_ingest_all"] = """SELECT user_id, timestamp, event_type, NULL::VARCHAR AS value FROM messages
  UNION ALL SELECT NULL, NULL, NULL, value FROM message_text WHERE user_id IN (11, 13)"""
_SQL["missing_hours_of_lake"] = _SQL["missing_hours"]


def oracle_sql() -> dict[str, str]:
    statements = {}
    for name, sql in _SQL.items():
        # a statement with a WITH clause of its own continues the list of named tables
        own = sql.startswith("WITH ")
        statements[name] = f"WITH {_BASE.strip()}{', ' + sql[5:] if own else ' ' + sql}"
    return statements
