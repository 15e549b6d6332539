"""The registered queries' results as DuckDB SQL over the given tables.

Every statement is a select over the same chain of common table expressions, which derives
messages, raw, staging, users, facts and logs from ``events`` with plain SQL.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
USERS_SINCE = "TIMESTAMP '2024-01-10 00:00:00'"

# Fixed values, written out here too so that a wrong one in the pipeline shows.
SEED_USERS = """
  (1, 'USR-001', 'John Smith', 'EMPLOYEE', 'Engineering', 'CONFIDENTIAL'),
  (2, 'USR-002', 'Jane Doe', 'EMPLOYEE', 'HR', 'PUBLIC'),
  (3, 'USR-003', 'Bob Johnson', 'CONTRACTOR', 'IT Support', 'PUBLIC'),
  (4, 'USR-004', 'Alice Williams', 'EMPLOYEE', 'Security', 'SECRET'),
  (5, 'USR-005', 'Mike Davis', 'VISITOR', 'External', 'PUBLIC')"""
SEED_ZONES = """
  (1, 'ZONE-LOBBY-1', 'RDR-101', 'Main Building', 1, 'Main Lobby', 'LOBBY', 100, NULL, false, 'Main Entrance', 'BIDIRECTIONAL'),
  (2, 'ZONE-OFFICE-2A', 'RDR-201', 'Main Building', 2, 'Engineering Office 2A', 'OFFICE', 30, 'CONFIDENTIAL', true,
    'Floor 2 East', 'ENTRY'),
  (3, 'ZONE-SERVER-B1', 'RDR-B101', 'Main Building', -1, 'Server Room B1', 'SECURE_AREA', 5, 'SECRET', true,
    'Basement Security Door', 'BIDIRECTIONAL'),
  (4, 'ZONE-CONF-3B', 'RDR-301', 'Main Building', 3, 'Conference Room 3B', 'CONFERENCE_ROOM', 20, NULL, false,
    'Floor 3 West', 'ENTRY'),
  (5, 'ZONE-PARKING-1', 'RDR-P01', 'Parking Structure', 1, 'Employee Parking Level 1', 'PARKING', 200, NULL, false,
    'Garage Entry', 'ENTRY')"""
PENDING_CHECK = "Stream Has Data?"
PENDING_TEXT = "WARNING:  Data pending (tasks still processing)"
DRAINED_TEXT = " Stream consumed (pipeline caught up)"

# The runs of the layout that was followed: a clock of a minute a reading from 23:30, and one failed attempt.
RUNS = """
  ('badge_stage_task', 'SUCCEEDED', 0, NULL), ('badge_enrich_task', 'SUCCEEDED', 2, NULL),
  ('badge_stage_task', 'SUCCEEDED', 4, NULL), ('badge_enrich_task', 'FAILED', 6, 'AnalysisException'),
  ('badge_stage_task', 'SUCCEEDED', 8, NULL), ('badge_enrich_task', 'SUCCEEDED', 10, NULL)"""


def _age(column: str) -> str:
    return f"date_diff('second', {column}, {AS_OF})"


_TABLES = f"""
delivered AS (
  SELECT *, unnest(CASE WHEN event_id % 20 = 0 THEN [0, 1] ELSE [0] END) AS redelivery FROM events
),
decoded AS (
  SELECT event_id, redelivery,
    CASE WHEN event_id % 97 <> 96 THEN 'BADGE-' || lpad(user_id::VARCHAR, 6, '0') END AS badge_id,
    'USR-' || CASE WHEN user_id < 1000 THEN lpad(user_id::VARCHAR, 3, '0') ELSE user_id::VARCHAR END AS user_id,
    (['ZONE-LOBBY-1', 'ZONE-OFFICE-2A', 'ZONE-SERVER-B1', 'ZONE-CONF-3B', 'ZONE-PARKING-1', 'ZONE-UNMAPPED']
    )[event_id % 6 + 1] AS zone_id,
    'RDR-' || (event_id % 6 + 100)::VARCHAR AS reader_id,
    replace(ts::VARCHAR, ' ', 'T') AS event_timestamp,
    CASE WHEN event_id % 11 <> 0
      THEN (-40.0 - event_id % 60 - 0.5 * (event_id % 2) - 5 * redelivery)::DOUBLE END AS signal_strength,
    CASE event_type WHEN 'click' THEN 'entry' WHEN 'view' THEN 'ENTRY'
      WHEN 'purchase' THEN 'exit' WHEN 'signup' THEN 'Exit' END AS direction,
    ts + to_seconds(event_id % 90 + 30 * redelivery) AS ingestion_time
  FROM delivered
),
lines AS (
  SELECT *,
    concat_ws(',', '"badge_id":"' || badge_id || '"', '"user_id":"' || user_id || '"',
      '"zone_id":"' || zone_id || '"', '"reader_id":"' || reader_id || '"',
      '"event_timestamp":"' || event_timestamp || '"', '"signal_strength":' || signal_strength::VARCHAR,
      '"direction":"' || direction || '"') AS body
  FROM decoded
),
messages AS (
  SELECT * EXCLUDE (body), '{{' || body || '}}' AS value,
    '{{' || body || ',"event_id":' || event_id || ',"redelivery":' || redelivery
      || ',"delivered_at":"' || replace(ingestion_time::VARCHAR, ' ', 'T') || '"}}' AS raw_json
  FROM lines
),
raw AS (
  SELECT badge_id, user_id, zone_id, reader_id, event_timestamp::TIMESTAMP AS event_timestamp,
    coalesce(whole, -999)::DOUBLE AS signal_strength,
    CASE WHEN whole < -80 THEN 'WEAK' WHEN whole < -60 THEN 'MEDIUM' ELSE 'STRONG' END AS signal_quality,
    upper(direction) AS direction, ingestion_time, raw_json, redelivery, event_id
  FROM (SELECT *, signal_strength::VARCHAR::DECIMAL(38, 0) AS whole FROM messages)
  WHERE badge_id IS NOT NULL
),
staging AS (
  SELECT DISTINCT ON (badge_id, event_timestamp) * EXCLUDE (raw_json, redelivery, event_id),
    ingestion_time + INTERVAL 60 SECOND AS staging_time
  FROM raw ORDER BY badge_id, event_timestamp, ingestion_time DESC
),
zones AS (
  SELECT *, true AS is_monitored, NULL::DOUBLE AS latitude, NULL::DOUBLE AS longitude,
    {AS_OF} AS created_timestamp, {AS_OF} AS updated_timestamp
  FROM (VALUES {SEED_ZONES}) t(zone_key, zone_id, reader_id, building_name, floor_number, zone_name,
    zone_type, capacity, requires_clearance, is_restricted, reader_location, reader_type)
),
seeded(user_key, user_id, user_name, user_type, department, clearance_level) AS (VALUES {SEED_USERS}),
created AS (
  SELECT user_id, 5 + row_number() OVER (ORDER BY substr(md5(user_id), 1, 3), user_id) AS user_key
  FROM (SELECT user_id FROM staging EXCEPT SELECT user_id FROM seeded)
),
users AS (
  SELECT user_key, user_id, user_name, user_type, department, NULL::VARCHAR AS email, NULL::VARCHAR AS phone,
    clearance_level, true AS is_active, {AS_OF} AS effective_start_date,
    NULL::TIMESTAMP AS effective_end_date, true AS is_current,
    {AS_OF} AS created_timestamp, {AS_OF} AS updated_timestamp
  FROM (FROM seeded UNION ALL
        SELECT user_key, user_id, 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'PUBLIC' FROM created)
),
first_staging AS (
  SELECT * EXCLUDE (raw_json, redelivery, event_id), ingestion_time + INTERVAL 60 SECOND AS staging_time
  FROM raw WHERE redelivery = 0
),
any_facts AS (
  SELECT source, ((('0x' || substr(digest, 1, 15))::BIGINT)::HUGEINT * 1152921504606846976::HUGEINT
      + ('0x' || substr(digest, 16, 15))::BIGINT)::VARCHAR AS event_key,
    user_key, zone_key, badge_id, s.reader_id, event_timestamp,
    event_timestamp::DATE AS event_day, extract(hour FROM event_timestamp) AS event_hour,
    extract(dow FROM event_timestamp) AS event_day_of_week, direction, signal_strength, signal_quality,
    is_restricted AS is_restricted_access,
    extract(hour FROM event_timestamp) NOT BETWEEN 6 AND 21 AS is_after_hours,
    extract(dow FROM event_timestamp) IN (0, 6) AS is_weekend, ingestion_time,
    staging_time + to_seconds(extract(second FROM event_timestamp)::BIGINT) AS fact_load_time
  FROM (
    SELECT *, md5(badge_id || '|' || epoch_us(event_timestamp)) AS digest
    FROM (SELECT 'batch' AS source, * FROM staging UNION ALL SELECT 'stream', * FROM first_staging)
  ) s
  JOIN users USING (user_id) JOIN zones USING (zone_id)
),
fact AS (SELECT * EXCLUDE (source) FROM any_facts WHERE source = 'batch'),
ingest_log AS (
  SELECT date_trunc('minute', ingestion_time) AS end_time, count(*) AS num_rows, sum(length(zone_id)) AS num_bytes,
    count(*) / 1e6 AS credits_used
  FROM raw GROUP BY 1
),
run_log AS (
  SELECT (['badge_stage_task', 'badge_enrich_task', 'nightly_report'])[event_id % 3 + 1] AS task_name,
    CASE WHEN event_id % 50 = 0 THEN 'FAILED' WHEN event_id % 51 = 0 THEN 'SKIPPED'
      WHEN event_id % 53 = 0 THEN 'EXECUTING' ELSE 'SUCCEEDED' END AS state,
    CASE WHEN event_id % 50 = 0 THEN '100035' END AS error_code,
    CASE WHEN event_id % 50 = 0 THEN 'run ' || event_id || ' failed' END AS error_message,
    event_type <> 'signup' AS ours, ts AS scheduled_time,
    CASE WHEN state <> 'EXECUTING' THEN ts + to_seconds(event_id % 7) END AS completed_time,
    date_diff('second', scheduled_time, completed_time) AS seconds,
    (event_id % 10) / 1000.0::DOUBLE AS credits_used
  FROM events
),
pending AS (SELECT * FROM raw WHERE redelivery = 1),
half_fact AS (SELECT * FROM any_facts WHERE source = 'stream'),
logged AS (
  SELECT date_trunc('minute', ingestion_time) AS end_time, count(*) AS num_rows, sum(strlen(raw_json)) AS num_bytes,
    count(*) * 1e-6 AS credits_used
  FROM raw GROUP BY redelivery, 1
),
runs AS (
  SELECT task_name, state, error_code, error_code IS NOT NULL AS error_message,
    TIMESTAMP '2024-01-30 23:30:00' + to_minutes(minute) AS scheduled_time,
    scheduled_time + INTERVAL 1 MINUTE AS completed_time
  FROM (VALUES {RUNS}) t(task_name, state, minute, error_code)
),
created_first AS (
  SELECT user_id, 5 + row_number() OVER (ORDER BY substr(md5(user_id), 1, 3), user_id) AS user_key
  FROM (SELECT user_id FROM raw WHERE redelivery = 1 EXCEPT SELECT user_id FROM seeded)
),
created_later AS (
  SELECT user_id, 5 + (SELECT count(*) FROM created_first)
    + row_number() OVER (ORDER BY substr(md5(user_id), 1, 3), user_id) AS user_key
  FROM (SELECT user_id FROM raw EXCEPT SELECT user_id FROM seeded EXCEPT SELECT user_id FROM created_first)
)
"""


def _newest(hours: int, limit: int) -> str:
    return (
        f"(SELECT * FROM (SELECT * FROM run_log WHERE scheduled_time >= {AS_OF} - INTERVAL {hours} HOUR "
        f"ORDER BY scheduled_time DESC, task_name, completed_time NULLS FIRST LIMIT {limit}) WHERE ours)"
    )


def _channel_status(log: str) -> str:
    return f"""
      SELECT 'RAW_BADGE_EVENTS' AS pipe_name, max(end_time) AS last_ingestion_time,
        {_age('max(end_time)')} AS seconds_since_last_ingestion, sum(num_rows)::BIGINT AS total_rows_inserted,
        sum(num_bytes) / {_GIB} AS total_gb_inserted, count(DISTINCT end_time) AS active_minutes_last_hour,
        avg(num_rows) AS avg_rows_per_insert, max(num_rows) AS max_rows_per_insert,
        round(sum(num_rows) / 1e6, 9) AS total_credits_used
      FROM {log} WHERE end_time >= {AS_OF} - INTERVAL 1 HOUR HAVING count(*) > 0"""


def _daily_cost(log: str) -> str:
    return f"""
      SELECT end_time::DATE::VARCHAR AS ingestion_date, sum(num_bytes) / {_GIB} AS gb_ingested,
        sum(num_rows)::BIGINT AS rows_ingested, round(sum(credits_used), 9) AS actual_credits_used,
        round(sum(num_rows) / (sum(num_bytes) / {_GIB})) AS rows_per_gb
      FROM {log} WHERE end_time >= {AS_OF} - INTERVAL 720 HOUR GROUP BY 1"""


def _cost_total(log: str) -> str:
    return f"""
      SELECT round(sum(credits_used), 9) AS total_credits_last_30_days
      FROM {log} WHERE end_time >= {AS_OF} - INTERVAL 720 HOUR"""


def _last_hour(layer: str, table: str, column: str) -> str:
    return (
        f"SELECT '{layer}' AS layer, max({column}) AS last_update, count(*) AS row_count "
        f"FROM {table} WHERE {column} >= {AS_OF} - INTERVAL 1 HOUR"
    )


def _freshness(name: str, table: str, arrival: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, max(event_timestamp) AS last_event_timestamp, "
        f"max({arrival}) AS last_ingestion_timestamp, {_age('max(event_timestamp)')} AS event_age_seconds, "
        f"{_age(f'max({arrival})')} AS ingestion_age_seconds, count(*) AS total_rows, "
        f"count(*) FILTER ({arrival} >= {AS_OF} - INTERVAL 1 HOUR) AS rows_last_hour FROM {table}"
    )


def _share(flag: str, label: str) -> str:
    return (
        f"SELECT '{label}' AS category, count(*) FILTER ({flag}) AS event_count, "
        f"round(100.0 * count(*) FILTER ({flag}) / count(*)::DOUBLE, 2) AS percentage FROM fact"
    )


def _counts(labels: tuple[str, str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS layer, count(*) AS row_count FROM {table}"
        for label, table in zip(labels, ("raw", "staging", "fact"))
    )


_DAY = "event_day::VARCHAR AS event_date"
_FACT = f"SELECT * EXCLUDE (event_day), {_DAY} FROM"
_RAW = "SELECT * EXCLUDE (redelivery, event_id) FROM raw"
_GIB = "1073741824.0::DOUBLE"

_STATEMENTS = {
    "ingest_stream": f"{_RAW} WHERE event_id % 50 <> 7",
    "ingest_stream_rejects": """
      SELECT badge_id, user_id, zone_id, reader_id, event_timestamp, signal_strength::VARCHAR AS signal_strength,
        direction, ingestion_time, raw_json, 'badge_id missing' AS broken_rules
      FROM messages WHERE badge_id IS NULL AND event_id % 50 <> 7
      UNION ALL
      SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, ingestion_time, raw_json || raw_json,
        'badge_id missing; user_id missing; zone_id missing; reader_id missing; event_timestamp missing'
      FROM messages WHERE event_id % 50 = 7""",
    "ingest_parse": _RAW,
    "sample_events": f"""
      SELECT 'BADGE-' || lpad(n, greatest(3, length(n))::INTEGER, '0') AS badge_id,
        'USR-' || lpad(n, greatest(3, length(n))::INTEGER, '0') AS user_id, 'ZONE-LOBBY-1' AS zone_id,
        'RDR-' || (event_id + 100) AS reader_id,
        replace(({AS_OF} - to_seconds(2 * (total - event_id)))::VARCHAR, ' ', 'T') || '+00:00' AS event_timestamp,
        event_id - 65.0::DOUBLE AS signal_strength,
        CASE WHEN event_id % 2 = 0 THEN 'ENTRY' ELSE 'EXIT' END AS direction
      FROM (SELECT event_id, event_id::VARCHAR AS n, (SELECT count(*) FROM events) AS total FROM events)""",
    "events_to_json": "SELECT value FROM messages",
    "fact_date_slice": f"{_FACT} fact WHERE event_day BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'",
    "swept_layers": """
      SELECT 'RAW' AS layer, ingestion_time::DATE::VARCHAR AS day, count(*) AS row_count
      FROM raw WHERE ingestion_time >= DATE '2024-01-20' GROUP BY ALL
      UNION ALL
      SELECT 'STAGING', staging_time::DATE::VARCHAR, count(*) FROM staging WHERE staging_time >= DATE '2024-01-20' GROUP BY ALL
      UNION ALL
      SELECT 'FACT', event_timestamp::DATE::VARCHAR, count(*) FROM staging GROUP BY ALL""",
    "staging_retention": f"SELECT * FROM staging WHERE staging_time >= {AS_OF} - INTERVAL 24 HOUR",
    "ingest_rejects": """
      SELECT badge_id, user_id, zone_id, reader_id, event_timestamp, signal_strength::VARCHAR AS signal_strength,
        direction, ingestion_time, raw_json, 'badge_id missing' AS broken_rules
      FROM messages WHERE badge_id IS NULL""",
    "signal_quality": "SELECT signal_strength, signal_quality, count(*) AS row_count FROM raw GROUP BY ALL",
    "raw_variant_paths": """
      SELECT badge_id, event_timestamp::TIMESTAMP AS event_timestamp, json_extract(grown, '$.event_id')::BIGINT AS event_id,
        json_extract(grown, '$.signal_strength')::DOUBLE AS exact_signal, json_extract_string(grown, '$.reader.firmware') AS firmware,
        json_extract(grown, '$.reader.hops[1]')::INTEGER AS second_hop, NULL::INTEGER AS zone_as_number,
        json_extract_string(grown, '$.reader.serial') AS serial
      FROM (
        SELECT *, CASE WHEN event_id % 3 = 0
          THEN left(raw_json, length(raw_json) - 1) || ',"reader":{"firmware":"v' || event_id % 4
            || '","hops":[' || event_id % 5 || ',' || event_id % 7 || ']}}'
          ELSE raw_json END AS grown
        FROM messages WHERE badge_id IS NOT NULL)""",
    "stage_dedup": "SELECT * FROM staging",
    "latest_rows_for_badge": """
      SELECT * EXCLUDE (redelivery, event_id) FROM raw WHERE badge_id = 'BADGE-000008'
      ORDER BY ingestion_time DESC, event_timestamp DESC LIMIT 10""",
    "dim_users_merge": "SELECT * FROM users",
    "scd2_apply": "SELECT * FROM changed_users",
    "cdc_actions": """
      SELECT 'DIM_USERS' AS table_name, user_key::VARCHAR AS row_key, department, effective_start_date, effective_end_date,
        change_action, min(change_action) OVER k <> max(change_action) OVER k AS is_update
      FROM (
        SELECT 'INSERT' AS change_action, * FROM (FROM changed_users EXCEPT FROM since_users)
        UNION ALL SELECT 'DELETE', * FROM (FROM since_users EXCEPT FROM changed_users)
      ) WINDOW k AS (PARTITION BY user_key)""",
    "fact_time_parts": """
      SELECT badge_id, event_timestamp, event_timestamp::DATE::VARCHAR AS event_date,
        extract(hour FROM event_timestamp) AS event_hour, extract(dow FROM event_timestamp) AS event_day_of_week,
        extract(hour FROM event_timestamp) NOT BETWEEN 6 AND 21 AS is_after_hours,
        extract(dow FROM event_timestamp) IN (0, 6) AS is_weekend
      FROM staging""",
    "fact_load": f"{_FACT} fact",
    "fact_user_ids": """
      SELECT badge_id, event_timestamp, user_id, user_key
      FROM (
        SELECT user_id, badge_id, event_timestamp FROM raw WHERE redelivery = 1 AND zone_id <> 'ZONE-UNMAPPED'
        UNION SELECT user_id, badge_id, event_timestamp FROM raw WHERE redelivery = 0 AND zone_id <> 'ZONE-UNMAPPED'
      ) JOIN (
        SELECT user_id, user_key FROM seeded UNION ALL FROM created_first UNION ALL FROM created_later
      ) USING (user_id)""",
    "facts_after_change": """
      SELECT user_key, count(*) AS fact_rows
      FROM (
        SELECT user_key FROM fact
        UNION ALL
        SELECT v.user_key
        FROM fact f JOIN users u USING (user_key) JOIN twice_changed v ON v.user_id = u.user_id AND v.stop IS NULL
      ) GROUP BY 1""",
    "unmapped_zones": "SELECT * FROM staging WHERE zone_id NOT IN (SELECT zone_id FROM zones)",
    "ingestion_metrics": f"""
      SELECT date_trunc('hour', ingestion_time) AS ingestion_hour, count(*) AS event_count,
        count(*) / 3600.0::DOUBLE AS events_per_second, count(DISTINCT badge_id) AS unique_badges,
        count(DISTINCT zone_id) AS unique_zones, round(avg(signal_strength), 2) AS avg_signal_strength,
        count(*) FILTER (signal_quality = 'WEAK') AS weak_signal_count,
        round(100.0 * count(*) FILTER (signal_quality = 'WEAK') / count(*)::DOUBLE, 2) AS weak_signal_pct,
        count(*) FILTER (direction = 'ENTRY') AS entry_count, count(*) FILTER (direction = 'EXIT') AS exit_count,
        count(*) FILTER (direction = 'ENTRY') - count(*) FILTER (direction = 'EXIT') AS net_occupancy_change
      FROM raw WHERE ingestion_time >= {AS_OF} - INTERVAL 24 HOUR GROUP BY 1""",
    "layer_latency": f"""
      SELECT *, {_age('last_update')} AS seconds_since_update,
        CASE WHEN {_age('last_update')} > 300 THEN 'STALE' WHEN {_age('last_update')} > 120 THEN 'WARNING'
          ELSE 'HEALTHY' END AS health_status
      FROM ({_last_hour('RAW', 'raw', 'ingestion_time')} UNION ALL
            {_last_hour('STAGING', 'staging', 'staging_time')} UNION ALL
            {_last_hour('ANALYTICS', 'fact', 'fact_load_time')})""",
    "data_freshness": _freshness("RAW_BADGE_EVENTS", "raw", "ingestion_time")
    + " UNION ALL " + _freshness("FCT_ACCESS_EVENTS", "fact", "fact_load_time"),
    "channel_status": _channel_status("ingest_log"),
    "channel_status_logged": _channel_status("logged"),
    "daily_ingest_cost": _daily_cost("ingest_log"),
    "daily_ingest_cost_logged": _daily_cost("logged"),
    "cost_total": _cost_total("ingest_log"),
    "cost_total_logged": _cost_total("logged"),
    "partition_efficiency": f"""
      SELECT table_name, queries::BIGINT AS query_count, round(ratio, 2) AS avg_scan_ratio_pct,
        round(rows_in / {_GIB}, 2) AS total_gb_scanned_approx,
        round(100.0 * rows_out / (rows_in + rows_out)::DOUBLE, 2) AS row_prune_ratio_pct,
        CASE WHEN ratio < 20 THEN 'EXCELLENT' WHEN ratio < 50 THEN 'GOOD' WHEN ratio < 80 THEN 'FAIR'
          ELSE 'POOR' END AS pruning_efficiency
      FROM (SELECT (['RAW_BADGE_EVENTS', 'FCT_ACCESS_EVENTS', 'DIM_ZONES'])[event_id % 3 + 1] AS table_name,
              sum(event_id % 5 + 1) AS queries,
              100.0 * sum(event_id % 40) / sum(event_id % 40 + event_id % 70)::DOUBLE AS ratio,
              sum(event_id % 1000 * 1000000) AS rows_in, sum(event_id % 700 * 1500000) AS rows_out
            FROM events WHERE ts >= {AS_OF} - INTERVAL 24 HOUR GROUP BY 1)
      WHERE table_name <> 'DIM_ZONES'""",
    "run_history": f"""
      SELECT task_name, state, scheduled_time, completed_time, seconds AS duration_seconds, error_code, error_message,
        CASE state WHEN 'SUCCEEDED' THEN 'SUCCESS' WHEN 'EXECUTING' THEN 'UNKNOWN' ELSE state END AS execution_status
      FROM {_newest(24, 1000)}""",
    "run_summary": f"""
      SELECT task_name, count(*) AS executions, avg(seconds) AS avg_duration
      FROM run_log WHERE scheduled_time >= {AS_OF} - INTERVAL 24 HOUR AND ours AND state = 'SUCCEEDED' GROUP BY 1""",
    "run_history_logged": """
      SELECT task_name, state, scheduled_time, completed_time, 60 AS duration_seconds, error_code, error_message,
        CASE state WHEN 'SUCCEEDED' THEN 'SUCCESS' ELSE state END AS execution_status FROM runs""",
    "run_summary_logged": """
      SELECT task_name, count(*) AS executions, 60.0::DOUBLE AS avg_duration FROM runs WHERE state = 'SUCCEEDED' GROUP BY 1""",
    "recent_runs_logged": """
      SELECT task_name, state, scheduled_time, completed_time, 60 AS duration_sec FROM runs ORDER BY scheduled_time DESC LIMIT 5""",
    "run_errors_logged": """
      SELECT task_name, state, scheduled_time, completed_time, 60 AS duration_sec, error_code, error_message FROM runs""",
    "task_credits_logged": """
      SELECT task_name, count(*) * 0.25::DOUBLE AS total_credits, count(*) AS execution_count, 0.25::DOUBLE AS avg_credits_per_run
      FROM runs GROUP BY 1""",
    "layer_row_counts": _counts(("RAW Layer", "STAGING Layer", "ANALYTICS Layer")),
    "layer_row_summary": _counts(("RAW_BADGE_EVENTS", "STG_BADGE_EVENTS", "FCT_ACCESS_EVENTS")),
    "pending_status": f"""
      SELECT '{PENDING_CHECK}' AS check_type, CASE WHEN n > 0 THEN 'true' ELSE 'false' END AS status,
        CASE WHEN n > 0 THEN '{PENDING_TEXT}' ELSE '{DRAINED_TEXT}' END AS interpretation
      FROM (SELECT count(*) AS n FROM pending)""",
    "pending_count": "SELECT 'Stream Pending Records' AS check_type, count(*) AS pending_count FROM pending",
    "recent_runs": f"""
      SELECT task_name, state, scheduled_time, completed_time, seconds AS duration_sec FROM {_newest(1, 5)}""",
    "run_errors": f"""
      SELECT task_name, state, scheduled_time, completed_time, seconds AS duration_sec, error_code, error_message
      FROM {_newest(2, 20)}""",
    "task_credits": f"""
      SELECT task_name, round(sum(credits_used), 9) AS total_credits, count(*) AS execution_count,
        round(avg(credits_used), 4) AS avg_credits_per_run
      FROM run_log WHERE task_name LIKE 'badge_%' AND scheduled_time >= {AS_OF} - INTERVAL 2 HOUR GROUP BY 1""",
    "raw_stats": """
      SELECT 'RAW_BADGE_EVENTS' AS table_name, count(*) AS row_count, count(DISTINCT badge_id) AS unique_badges,
        count(DISTINCT zone_id) AS unique_zones, min(event_timestamp) AS earliest_event,
        max(event_timestamp) AS latest_event, min(ingestion_time) AS first_ingestion,
        max(ingestion_time) AS last_ingestion FROM raw""",
    "staging_stats": """
      SELECT 'STG_BADGE_EVENTS' AS table_name, count(*) AS row_count, count(DISTINCT badge_id) AS unique_badges,
        min(event_timestamp) AS earliest_event, max(event_timestamp) AS latest_event FROM staging""",
    "user_dim_stats": """
      SELECT 'DIM_USERS' AS dimension_name, count(*) AS total_users,
        count(*) FILTER (user_name = 'UNKNOWN') AS auto_created_users,
        count(*) FILTER (user_name <> 'UNKNOWN') AS seed_users FROM users""",
    "auto_users_sample": """
      SELECT 'Sample Auto-Created Users' AS check_type, user_id, user_name, clearance_level, created_timestamp
      FROM users WHERE user_name = 'UNKNOWN' ORDER BY user_id LIMIT 5""",
    "fact_stats": """
      SELECT 'FCT_ACCESS_EVENTS' AS table_name, count(*) AS total_events, count(DISTINCT badge_id) AS unique_badges,
        count(DISTINCT zone_key) AS unique_zones, min(event_day)::VARCHAR AS earliest_date,
        max(event_day)::VARCHAR AS latest_date, min(event_timestamp) AS earliest_timestamp,
        max(event_timestamp) AS latest_timestamp FROM fact""",
    "events_by_date": """
      SELECT event_day::VARCHAR AS event_date, count(*) AS event_count, count(DISTINCT badge_id) AS unique_badges,
        count(DISTINCT zone_key) AS unique_zones FROM fact GROUP BY event_day ORDER BY event_day DESC LIMIT 10""",
    "direction_distribution": """
      SELECT direction, count(*) AS event_count,
        round(100.0 * count(*) / (SELECT count(*) FROM fact)::DOUBLE, 2) AS percentage FROM fact GROUP BY 1""",
    "signal_distribution": """
      SELECT signal_quality, count(*) AS event_count, round(avg(signal_strength), 2) AS avg_signal_strength,
        min(signal_strength) AS min_signal, max(signal_strength) AS max_signal FROM fact GROUP BY 1""",
    "flagged_access": " UNION ALL ".join([
        _share("is_after_hours", "After-Hours Events"), _share("is_weekend", "Weekend Events"),
        _share("is_restricted_access", "Restricted Access Events"),
    ]),
    "top_zones": """
      SELECT zone_name, zone_type, building_name, count(*) AS access_count FROM fact JOIN zones USING (zone_key)
      GROUP BY ALL ORDER BY access_count DESC, zone_name, zone_type, building_name LIMIT 5""",
    "top_badges": """
      SELECT badge_id, user_name, user_type, department, count(*) AS access_count FROM fact JOIN users USING (user_key)
      GROUP BY ALL ORDER BY access_count DESC, badge_id, user_name, user_type, department LIMIT 5""",
    "null_check": """
      SELECT 'Completeness Check' AS check_type, count(*) AS total_records,
        count(*) - count(badge_id) AS null_badge_id, count(*) - count(user_key) AS null_user_key,
        count(*) - count(zone_key) AS null_zone_key, count(*) - count(event_timestamp) AS null_timestamp,
        count(*) - count(direction) AS null_direction FROM fact""",
    "ingestion_latency": """
      SELECT 'Ingestion Latency' AS metric, min(s) AS min_latency_sec, max(s) AS max_latency_sec,
        avg(s) AS avg_latency_sec, median(s)::DOUBLE AS median_latency_sec
      FROM (SELECT date_diff('second', ingestion_time, fact_load_time) AS s FROM fact)""",
    "pipeline_health": f"""
      WITH seen(rule, observed) AS (
        SELECT 'staging covers facts', (SELECT count(*) FROM first_staging) - (SELECT count(*) FROM half_fact)
        UNION ALL SELECT 'no pending rows', (SELECT count(*) FROM pending)
        UNION ALL SELECT 'latency below 120 s', max(date_diff('second', ingestion_time, fact_load_time)) FROM half_fact
        UNION ALL SELECT 'required fields present', count(*) FROM half_fact
          WHERE concat(badge_id, user_key, zone_key, event_timestamp) IS NULL
        UNION ALL SELECT 'no failed runs', count(*) FROM run_log
          WHERE state = 'FAILED' AND scheduled_time >= {AS_OF} - INTERVAL 2 HOUR)
      SELECT rule, observed, CASE rule WHEN 'staging covers facts' THEN observed >= 0
        WHEN 'latency below 120 s' THEN observed < 120 ELSE observed = 0 END AS ok FROM seen""",
    "dq_staging_pk": """
      SELECT badge_id, event_timestamp, count(*) AS row_count FROM raw GROUP BY ALL HAVING count(*) > 1""",
    "dq_dim_unique": """
      SELECT 'DIM_READERS' AS table_name, reader_id AS id, count(*) AS row_count
      FROM (SELECT DISTINCT reader_id, direction FROM raw) GROUP BY ALL HAVING count(*) > 1
      UNION ALL
      SELECT 'DIM_ZONES', zone_id, count(*) FROM (SELECT DISTINCT zone_id, reader_id, direction FROM raw)
      GROUP BY ALL HAVING count(*) > 1
      UNION ALL
      SELECT 'DIM_USERS', user_id, count(*) FROM (SELECT DISTINCT user_id, direction FROM raw)
      WHERE direction IS DISTINCT FROM 'EXIT' GROUP BY ALL HAVING count(*) > 1""",
    "dq_fact_fk": """
      SELECT 'user_key' AS key_column, 2 * user_key AS missing_key, count(*) AS fact_rows FROM fact
      WHERE 2 * user_key NOT IN (SELECT user_key FROM users) GROUP BY ALL
      UNION ALL
      SELECT 'zone_key', zone_key + 2, count(*) FROM fact WHERE zone_key + 2 > 5 GROUP BY ALL""",
    "dq_required": "SELECT 'badge_id missing' AS rule, count(*) AS row_count FROM decoded WHERE badge_id IS NULL",
    "dq_required_broken": """
      SELECT rule, count(*) AS row_count
      FROM (
        SELECT CASE event_id % 50 WHEN 1 THEN 'user_id missing' WHEN 2 THEN 'zone_id missing'
          WHEN 3 THEN 'reader_id missing' WHEN 4 THEN 'event_timestamp missing' WHEN 5 THEN 'badge_id too long'
          WHEN 6 THEN 'user_id too long' WHEN 7 THEN 'zone_id too long' WHEN 8 THEN 'reader_id too long'
          WHEN 9 THEN 'event_timestamp not a timestamp' WHEN 10 THEN 'signal_strength not a number'
          WHEN 11 THEN 'direction too long' WHEN 12 THEN 'event_timestamp out of range'
          WHEN 13 THEN 'signal_strength out of range' END AS rule
        FROM decoded
        UNION ALL
        SELECT 'badge_id missing' FROM decoded WHERE badge_id IS NULL AND event_id % 50 <> 5
      ) WHERE rule IS NOT NULL GROUP BY 1""",
    "null_check_broken": """
      SELECT 'Completeness Check' AS check_type, count(*) AS total_records,
        count(*) FILTER (event_hour % 5 = 0) AS null_badge_id, count(*) FILTER (event_hour % 7 = 0) AS null_user_key,
        count(*) FILTER (event_hour % 11 = 0) AS null_zone_key, count(*) FILTER (event_hour % 13 = 0) AS null_timestamp,
        count(*) FILTER (direction IS NULL) AS null_direction FROM fact""",
    "cdc_incremental": """
      SELECT * EXCLUDE (raw_json, redelivery, event_id), ingestion_time + INTERVAL 60 SECOND AS staging_time,
        redelivery AS batch_id FROM raw""",
    "fact_load_incremental": f"{_FACT} (SELECT * EXCLUDE (source) FROM any_facts WHERE source = 'stream')",
    "ingestion_metrics_stream": """
      SELECT date_trunc('hour', ingestion_time) AS window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS event_count,
        count(DISTINCT badge_id) AS unique_badges, count(DISTINCT zone_id) AS unique_zones,
        round(avg(signal_strength), 2) AS avg_signal_strength,
        count(*) FILTER (signal_quality = 'WEAK') AS weak_signal_count,
        count(*) FILTER (direction = 'ENTRY') AS entry_count, count(*) FILTER (direction = 'EXIT') AS exit_count,
        count(*) FILTER (direction = 'ENTRY') - count(*) FILTER (direction = 'EXIT') AS net_occupancy_change
      FROM raw GROUP BY 1""",
    "stream_dedup_first": """
      SELECT DISTINCT ON (badge_id, event_timestamp) * EXCLUDE (raw_json, redelivery, event_id) FROM raw
      ORDER BY badge_id, event_timestamp, (event_id // 20 + 2 * redelivery) % 3, ingestion_time""",
}

def _changed(name: str, versions: str, changes: str) -> str:
    """Versions (user_key, user_id, department, start, stop, created, updated) after changes (user_id, moment, department)."""
    lasting = "(stop IS NULL OR stop > start)"
    window = "WINDOW w AS (PARTITION BY user_id ORDER BY moment, kind, user_key)"
    return f"""
{name}_held AS (SELECT * FROM {versions} WHERE {lasting} AND user_id IN (SELECT user_id FROM {changes})),
{name}_events AS (
  SELECT user_id, start AS moment, 1 AS kind, user_key, department, stop, created, updated FROM {name}_held
  UNION ALL
  SELECT user_id, stop, 0, NULL, NULL, NULL, NULL, NULL FROM {name}_held e
  WHERE stop IS NOT NULL AND NOT EXISTS (FROM {name}_held s WHERE s.user_id = e.user_id AND s.start = e.stop)
  UNION ALL
  SELECT user_id, moment, 2, NULL, department, NULL, NULL, NULL FROM {changes}
),
{name}_kept AS (
  SELECT * FROM (SELECT *, lag(department) OVER w AS held FROM {name}_events {window})
  WHERE kind <> 2 OR held IS DISTINCT FROM department
),
{name}_pieces AS (
  SELECT *, lead(moment) OVER w AS next_at, lag(moment) OVER w AS previous_at,
    coalesce(lead(kind) OVER w = 1 AND lead(department) OVER w = department, false) AS into_next,
    coalesce(lag(kind) OVER w = 2 AND lag(department) OVER w = department, false) AS from_previous
  FROM {name}_kept {window}
),
{name} AS (
  SELECT * FROM {versions} WHERE NOT {lasting} OR user_id NOT IN (SELECT user_id FROM {changes})
  UNION ALL
  SELECT user_key, user_id, department, CASE WHEN from_previous THEN previous_at ELSE moment END, next_at, created,
    CASE WHEN from_previous OR next_at IS DISTINCT FROM stop THEN {AS_OF} ELSE updated END
  FROM {name}_pieces WHERE kind = 1
  UNION ALL
  SELECT (SELECT max(user_key) FROM {versions}) + row_number() OVER (ORDER BY substr(md5(id), 1, 3), id),
    user_id, department, moment, next_at, {AS_OF}, {AS_OF}
  FROM (SELECT *, user_id || '|' || epoch_us(moment) AS id FROM {name}_pieces WHERE kind = 2 AND NOT into_next)
)"""


def _department_changes(name: str, which: str) -> str:
    return f"""
{name} AS (
  SELECT user_id, ingestion_time AS moment, max(coalesce(upper(direction), 'UNKNOWN')) AS department
  FROM decoded WHERE {which} GROUP BY ALL
)"""


# Two loads of changes of departments, every third message coming later than the others.
_VERSIONS = ",".join([
    "",
    _department_changes("first_changes", "event_id % 3 <> 0"),
    _department_changes("late_changes", "event_id % 3 = 0"),
    f"""
loaded_users AS (
  SELECT user_key, user_id, department, {USERS_SINCE} AS start, NULL::TIMESTAMP AS stop, {USERS_SINCE} AS created, {USERS_SINCE} AS updated
  FROM users
)""",
    _changed("once_changed", "loaded_users", "first_changes"),
    _changed("twice_changed", "once_changed", "late_changes"),
    f"""
since_users AS (
  SELECT * REPLACE ({USERS_SINCE} AS effective_start_date, {USERS_SINCE} AS created_timestamp, {USERS_SINCE} AS updated_timestamp)
  FROM users
),
changed_users AS (
  SELECT u.* REPLACE (v.user_key AS user_key, v.department AS department, start AS effective_start_date,
    stop AS effective_end_date, stop IS NULL AS is_current, created AS created_timestamp, updated AS updated_timestamp)
  FROM twice_changed v JOIN users u USING (user_id)
)""",
])


# The same results from a second stream, and from rollups.
_STATEMENTS["fact_load_chained"] = _STATEMENTS["fact_load_incremental"]
_STATEMENTS |= {f"{name}_rolled": _STATEMENTS[name] for name in ("ingestion_metrics", "raw_stats")}


def statements() -> dict[str, str]:
    return {name: f"WITH {_TABLES}{_VERSIONS}\nSELECT * FROM ({sql})" for name, sql in _STATEMENTS.items()}
