"""DuckDB twins of :mod:`sensorwerk.plans.load_queries`, over the tables alone (no job is run)."""
from __future__ import annotations

_HOURS = """,
w AS (
  SELECT date_trunc('hour', event_ts) AS window_start, plant_id, event_name, unit,
    RND(AVG(value_numeric), 4) AS avg_value, MIN(value_numeric) AS min_value, MAX(value_numeric) AS max_value,
    RND(STDDEV_SAMP(value_numeric), 4) AS stddev_value, COUNT(*) AS event_count,
    RND(AVG(quality), 4) AS avg_quality, COUNT(*) FILTER (WHERE quality < 80) AS low_quality_count
  FROM iot_raw GROUP BY 1, 2, 3, 4)
SELECT * FROM w
"""

#: name -> (common table expressions it needs, SQL)
SQL = {
    "stream_window_open": (("iot_raw",), _HOURS),
    "stream_window_arrivals": (("iot_raw",), """
SELECT COUNT(*) AS rows_in, COUNT(event_ts) AS in_windows, TRUE AS accounted, TRUE AS several_batches, TRUE AS late_rows_came FROM iot_raw
"""),
    "upsert_snapshot": (("fact",), """,
dated AS (
  SELECT event_sk, event_id, device_sk, value_numeric, event_ts,
    CASE WHEN event_sk % 7 <> 0 THEN CAST(event_ts AS DATE) END AS event_date FROM fact),
sent AS (
  SELECT event_id, device_sk, value_numeric + 1 AS value_numeric,
    CASE WHEN event_sk % 3 = 0 THEN CAST(event_ts AS DATE) + 1 ELSE event_date END AS event_date
  FROM dated WHERE event_ts >= TIMESTAMP '2024-01-15 00:00:00')
SELECT event_id, device_sk, value_numeric, event_date FROM sent
UNION ALL
SELECT event_id, device_sk, value_numeric, event_date FROM dated t
WHERE event_ts < TIMESTAMP '2024-01-20 00:00:00' AND NOT EXISTS (SELECT 1 FROM sent s WHERE s.event_id = t.event_id)
"""),
    "minute_stats_loads": (("fact",), """,
folded AS (
  SELECT event_id, device_sk % 5 AS device_sk, event_name, date_trunc('day', event_ts) + to_minutes(event_sk % 5) AS event_ts,
    CASE WHEN event_sk % 9 = 0 THEN value_numeric * 2 ELSE value_numeric END AS value_numeric
  FROM fact)
SELECT event_id, device_sk, event_name, event_ts, value_numeric,
  RND(AVG(value_numeric) OVER same, 4) AS avg_value_1min, RND(STDDEV_SAMP(value_numeric) OVER same, 4) AS stddev_value_1min
FROM folded WINDOW same AS (PARTITION BY device_sk, event_name, event_ts)
"""),
    "staging_cycle": (("fact",), """
SELECT event_id, device_sk, CASE WHEN event_ts >= TIMESTAMP '2024-01-15 00:00:00' THEN value_numeric + 1 ELSE value_numeric END AS value_numeric,
  0 AS files_left FROM fact
"""),
    "log_job_twice": (("log_enriched",), """
SELECT event_id, event_timestamp, event_type, severity, event_ts,
  CAST(year(event_ts) AS VARCHAR) AS year, lpad(CAST(month(event_ts) AS VARCHAR), 2, '0') AS month,
  lpad(CAST(day(event_ts) AS VARCHAR), 2, '0') AS day, lpad(CAST(hour(event_ts) AS VARCHAR), 2, '0') AS hour,
  plant_code, event_type = 'ALARM' AS is_alarm, severity = 'CRITICAL' AS is_critical,
  CASE WHEN temperature_c IS NOT NULL THEN RND(temperature_c * 9 / 5 + 32, 2) END AS temp_fahrenheit
FROM log_enriched WHERE dq_pass = TRUE
"""),
    "machine_log_load": (("log_enriched", "dim_device", "dim_plant"), """
SELECT event_id, machine_id, COALESCE(d.device_sk, -1) AS device_sk, COALESCE(p.plant_sk, -1) AS plant_sk,
  CAST(strftime(event_ts, '%Y%m%d') AS INTEGER) AS date_sk, event_ts, event_type, severity, event_type = 'ALARM' AS is_alarm,
  severity = 'CRITICAL' AS is_critical,
  CASE WHEN event_type = 'ALARM' AND no % 13 <> 0 THEN CAST(no % 11 AS INTEGER) END AS resolution_minutes,
  CAST(year(event_ts) AS SMALLINT) AS year, CAST(month(event_ts) AS SMALLINT) AS month
FROM (SELECT *, CAST(substring(event_id, 5) AS BIGINT) AS no FROM log_enriched WHERE dq_pass = TRUE) l
LEFT JOIN dim_device d ON d.device_id = l.machine_id LEFT JOIN dim_plant p ON p.plant_id = l.plant_code
"""),
    "log_job_failures": (("log_enriched",), """
SELECT event_id, event_timestamp, plant_code, dq_pass, dq_reason, CAST(year(event_ts) AS VARCHAR) AS year,
  lpad(CAST(month(event_ts) AS VARCHAR), 2, '0') AS month
FROM log_enriched WHERE NOT dq_pass_strict
"""),
    "log_job_quarantine": ((), """
SELECT '{"event_id": "LOG-' || CAST(event_id AS VARCHAR) || '", ' AS raw_value, 'run-' || CAST(event_id % 2 AS VARCHAR) AS job_run, TRUE AS unparsed
FROM events WHERE event_id % 50 = 0
"""),
    "log_job_runs": ((), """
SELECT 'run-' || CAST(k AS VARCHAR) AS job_run, TRUE AS files_once,
  (SELECT COUNT(*) FROM events WHERE event_id % 50 = 0 AND event_id % 2 = k) AS corrupt_records
FROM (SELECT unnest([0, 1]) AS k)
"""),
    "scd2_asof_carry": (("iot_raw", "dim_device_scd2"), """
SELECT r.event_id, r.device_id, r.event_ts, v.criticality AS criticality_at_event, v.sla_minutes, v.valid_from
FROM iot_raw r LEFT JOIN dim_device_scd2 v
  ON v.device_id = r.device_id AND r.event_ts >= v.valid_from AND (v.valid_to IS NULL OR r.event_ts < v.valid_to)
"""),
    "lake_discovery": (("iot_raw",), """
SELECT event_id, device_id, value_numeric, CASE WHEN event_ts >= TIMESTAMP '2024-01-20 00:00:00' THEN quality END AS quality,
  CAST(event_ts AS DATE) AS event_date
FROM iot_raw WHERE event_ts IS NOT NULL
"""),
    "model_graph": (("fact", "dim_plant"), """
SELECT CAST(date_trunc('week', event_ts) AS DATE) AS week_start, plant_name, COUNT(*) AS total_events,
  COUNT(*) FILTER (WHERE threshold_breach) AS total_alarms, COUNT(*) FILTER (WHERE anomaly_score > 0.8) AS high_anomalies,
  RND(AVG(value_numeric), 4) AS avg_value, RND(AVG(quality), 4) AS avg_quality
FROM fact JOIN dim_plant USING (plant_sk) WHERE event_ts IS NOT NULL GROUP BY plant_sk, plant_name, 1
"""),
    "registry_missing": (("iot_raw",), """
SELECT event_id, device_id, CAST(NULL AS VARCHAR) AS asset_name, CAST(NULL AS VARCHAR) AS criticality FROM iot_raw
"""),
    "staging_json": (("iot_raw",), """
SELECT event_id, '["' || unit || '","' || event_name || '"]' AS tags,
  '{"device_id":"' || device_id || '"' || CASE WHEN quality IS NOT NULL THEN ',"quality":' || CAST(quality AS VARCHAR) ELSE '' END || '}' AS reading
FROM iot_raw
"""),
    "stream_batch_metrics": (("iot_raw",), """
SELECT COUNT(*) AS records, COUNT(*) FILTER (WHERE value_numeric > alert_threshold) AS alarms, TRUE AS several_batches FROM iot_raw
"""),
    "topic_landing": ((), """
SELECT 'factory-iot-events' AS topic, event_id AS "offset", CAST(event_id % 3 AS INTEGER) AS "partition",
  'DEVICE-' || printf('%05d', user_id) AS key, CAST(year(t) AS VARCHAR) AS year, lpad(CAST(month(t) AS VARCHAR), 2, '0') AS month,
  lpad(CAST(day(t) AS VARCHAR), 2, '0') AS day, lpad(CAST(hour(t) AS VARCHAR), 2, '0') AS hour, event_id % 40 = 0 AS dead_letter
FROM (SELECT *, CASE WHEN event_id % 40 <> 0 THEN ts END AS t FROM events) e
"""),
    "hourly_refresh": (("fact", "dim_plant"), """,
now AS (
  SELECT event_ts, plant_sk, threshold_breach, anomaly_score,
    CASE WHEN event_ts >= TIMESTAMP '2024-01-15 00:00:00' THEN quality - 1 ELSE quality END AS quality
  FROM fact WHERE event_ts IS NOT NULL)
SELECT date_trunc('hour', event_ts) AS event_hour, plant_name, COUNT(*) AS total_events,
  COUNT(*) FILTER (WHERE threshold_breach) AS alarm_count, COUNT(*) FILTER (WHERE anomaly_score > 0.8) AS high_anomaly_count,
  COUNT(*) FILTER (WHERE quality < 60) AS low_quality_events, CAST(SUM(quality) AS BIGINT) AS sum_quality, COUNT(quality) AS n_quality
FROM now JOIN dim_plant USING (plant_sk) GROUP BY plant_sk, plant_name, 1
"""),
    "approx_distinct_bounds": (("fact",), """
SELECT CAST(date_trunc('week', event_ts) AS DATE) AS week_start, plant_sk, COUNT(DISTINCT device_sk) AS exact_devices,
  TRUE AS hll_within, TRUE AS sketch_within
FROM fact WHERE plant_sk IS NOT NULL GROUP BY 1, 2
"""),
}
SQL["cycle_hourly"] = SQL["hourly_refresh"]
