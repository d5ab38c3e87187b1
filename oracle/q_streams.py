"""Oracle SQL for H01–H09: the batch form of each stream, keeping only what the
watermark has closed (window end <= max(event time) - 10 minutes)."""

from .q_routing import _exp
from .queries import ORACLE, with_ctes

WM = "((SELECT max(ts) FROM events) - INTERVAL 10 MINUTE)"

ORACLE["telemetry_tumbling"] = with_ctes(f"""
SELECT device_id, date_trunc('hour', "timestamp") AS window_start, date_trunc('hour', "timestamp") + INTERVAL 1 HOUR AS window_end,
  count(*) AS readings, round(avg(power_consumption), 4) AS mean_power, count_if(operational_status = 'ERROR') AS errors
FROM telemetry GROUP BY 1, 2, 3 HAVING date_trunc('hour', "timestamp") + INTERVAL 1 HOUR <= {WM}""", "telemetry")

ORACLE["telemetry_sliding"] = with_ctes(f"""
, w AS (SELECT location_id, operational_status,
          time_bucket(INTERVAL 15 MINUTE, "timestamp") - to_minutes(15 * k) AS window_start
        FROM telemetry, (SELECT unnest(generate_series(0, 3)) AS k))
SELECT location_id, window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS readings,
  count_if(operational_status = 'ERROR') AS errors
FROM w GROUP BY ALL HAVING window_start + INTERVAL 1 HOUR <= {WM}""", "telemetry")

ORACLE["error_sessions"] = with_ctes(f"""
, e AS (SELECT device_id, "timestamp" AS ts FROM telemetry WHERE operational_status = 'ERROR'),
g AS (SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY device_id ORDER BY ts) IS NULL
                      OR ts - lag(ts) OVER (PARTITION BY device_id ORDER BY ts) >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS brk FROM e),
s AS (SELECT *, sum(brk) OVER (PARTITION BY device_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT device_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS errors
FROM s GROUP BY device_id, sid HAVING max(ts) + INTERVAL 30 MINUTE <= {WM}""", "telemetry")

ORACLE["dedup_readings"] = with_ctes("SELECT * FROM telemetry", "telemetry")

ORACLE["status_change_alerts"] = with_ctes(f"""
, l AS (SELECT device_id, "timestamp", reading_id, operational_status AS new_status,
          lag(operational_status) OVER (PARTITION BY device_id ORDER BY "timestamp", reading_id) AS previous_status FROM telemetry)
SELECT device_id, "timestamp", reading_id, previous_status, new_status FROM l
WHERE previous_status IS NOT NULL AND previous_status <> new_status
  AND time_bucket(INTERVAL 10 MINUTE, "timestamp") + INTERVAL 10 MINUTE <= {WM}""", "telemetry")

ORACLE["stream_index_sync"] = with_ctes("SELECT id, label, content_hash FROM vixu", "vixu")

ORACLE["stream_trace_scoring"] = with_ctes(f"""
, t AS (SELECT s.trace_id AS case_id, list_sort(list_distinct(list(endpoint))) AS called_tools, arg_min(endpoint, (start, span_id)) AS entry,
          count(*) AS spans, count_if(error) AS errors, count_if(duration_ms > 2000) AS slow
        FROM spans s JOIN events e ON e.event_id = s.span_id
        WHERE ((user_id % 2147483647) * 2654435761 + datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) * 97) % 1000 < 100
        GROUP BY s.trace_id HAVING date_trunc('day', min(start)) + INTERVAL 1 DAY <= {WM}),
c AS (SELECT *, {_exp} AS expected_tools FROM t)
SELECT case_id, expected_tools, called_tools, spans, errors, slow,
  CASE WHEN len(called_tools) > 0 THEN len(list_intersect(expected_tools, called_tools)) / len(called_tools) END AS precision,
  CASE WHEN len(expected_tools) > 0 THEN len(list_intersect(expected_tools, called_tools)) / len(expected_tools) END AS recall,
  list_sort(list_distinct(expected_tools)) = list_sort(list_distinct(called_tools)) AS exact FROM c""", "spans")

ORACLE["late_readings"] = with_ctes("""
, d AS (SELECT *, (CAST(substr(device_id, 4) AS BIGINT) - 1) % 4 AS step FROM telemetry),
w AS (SELECT a.step, (SELECT max("timestamp") FROM d b WHERE b.step < a.step) - INTERVAL 10 MINUTE AS wm FROM (SELECT DISTINCT step FROM d) a)
SELECT reading_id, device_id, "timestamp" FROM d JOIN w USING (step) WHERE date_trunc('hour', "timestamp") + INTERVAL 1 HOUR <= wm""", "telemetry")

ORACLE["stream_enrich"] = with_ctes("""
SELECT reading_id, device_id, "timestamp", power_consumption, device_type, location_id FROM telemetry""", "telemetry")
