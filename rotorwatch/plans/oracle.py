"""Independent DuckDB SQL for every registered query that SQL can express.

The telemetry view is re-derived from ``events`` in SQL (FIXTURES.md section
4), so the oracle shares no code with the Spark side.
"""

from __future__ import annotations

TELEMETRY = """
ev AS (
  SELECT event_id, user_id, value, epoch_us(ts) AS us, CAST(json_extract(props, '$.k') AS BIGINT) AS k
  FROM events
),
ev2 AS (
  SELECT event_id, user_id, k,
         'machine-0' || CAST(user_id % 6 + 1 AS VARCHAR) AS device_id,
         CAST(round(value * 100) AS BIGINT) % 1500 AS c,
         event_id % 20 = 0 AS anom,
         (user_id % 6 = 5 AND us >= 1706486400000000) AS tail,
         1704067200000000 + (us - 1704067200000000) // 15 AS cus
  FROM ev
),
tele AS (
  SELECT event_id, device_id,
         CASE WHEN event_id % 211 = 0 THEN '' ELSE device_id END AS body_machine_id,
         CASE WHEN event_id % 307 = 5 THEN NULL
              WHEN event_id % 97 = 0 THEN make_timestamp(cus // 300000000 * 300000000)
              ELSE make_timestamp(cus) END AS event_time,
         CAST(6000 + c + CASE WHEN anom THEN 1500 + c ELSE 0 END + CASE WHEN tail THEN 4000 ELSE 0 END AS DOUBLE)
           / 100 AS temperature,
         CASE WHEN event_id % 50 = 7 THEN NULL
              ELSE CAST(200 + (k % 60) * 10 + CASE WHEN anom THEN 1500 + c ELSE 0 END AS DOUBLE) / 1000 END
           AS vibration,
         CAST(1200 + k * 6 AS DOUBLE) AS rpm,
         CASE WHEN anom OR tail THEN 'warning' ELSE 'running' END AS status,
         make_timestamp(cus + 1000000) AS enqueued_at
  FROM ev2
),
readings AS (
  SELECT coalesce(nullif(body_machine_id, ''), device_id) AS machine_id,
         event_time, temperature, vibration, rpm, status, event_id
  FROM tele
)"""


def with_tele(*ctes: str) -> str:
    """``WITH`` clause: the telemetry view followed by the given CTEs."""
    return "WITH " + ",\n".join([TELEMETRY.strip()] + [c.strip() for c in ctes])


def mean(c: str) -> str:
    """Exact sum of doubles between 2 ** -16 and 2 ** 16 as an integer of 2 ** -68ths, rounded once (as two doubles are added),
    then divided by the count."""
    total, step = f"sum(CAST({c} * {2.0 ** 68!r} AS HUGEINT))", 1 << 40
    return f"(CAST({total} // {step} AS DOUBLE) * {float(step)!r} + CAST({total} % {step} AS DOUBLE)) / count({c}) / {2.0 ** 68!r}"


def fixed(c: str, digits: int) -> str:
    return f"coalesce(CAST(CAST(round(CAST({c} AS DECIMAL(18,6)), {digits}) AS DECIMAL(18,{digits})) AS VARCHAR), 'nan')"


WINDOWS = f"""
windows AS (
  SELECT machine_id,
         make_timestamp(((epoch_us(event_time) - 1) // 300000000 + 1) * 300000000) AS window_end,
         {mean('temperature')} AS avg_temp,
         max(temperature) AS max_temp,
         {mean('vibration')} AS avg_vibration,
         max(vibration) AS max_vibration,
         CASE WHEN max(vibration) > 2.0 OR max(temperature) > 95 THEN 'ALERT' ELSE 'OK' END AS health_status
  FROM readings
  WHERE event_time IS NOT NULL AND machine_id IS NOT NULL
  GROUP BY 1, 2
)"""


ORACLE: dict[str, str] = {}

ORACLE["window_status"] = with_tele(WINDOWS) + "\nSELECT * FROM windows"

ORACLE["window_status_closed"] = with_tele(WINDOWS) + """
SELECT * FROM windows WHERE window_end <= TIMESTAMP '2024-01-02 12:00:00'"""

READING_COLS = "machine_id, event_time, temperature, vibration, rpm, status, event_id"
# The required reading fields, in the order the report lists them.
REQUIRED = ("machine_id", "event_time", "temperature", "vibration", "rpm", "status")
INCOMPLETE = ("(machine_id IS NULL OR event_time IS NULL OR temperature IS NULL OR vibration IS NULL "
              "OR rpm IS NULL OR status IS NULL)")

ORACLE["telemetry_parse"] = with_tele() + f"\nSELECT {READING_COLS} FROM readings"
ORACLE["envelope_roundtrip"] = ORACLE["telemetry_parse"]
ORACLE["telemetry_parse_enqueued"] = with_tele() + """
SELECT coalesce(nullif(body_machine_id, ''), device_id) AS machine_id, enqueued_at AS event_time,
       temperature, vibration, rpm, status, event_id
FROM tele"""
ORACLE["malformed_lines"] = "SELECT event_id, event_id % 401 = 3 AS corrupt FROM events"

_MACHINE_NO = r"CAST(regexp_extract(machine_id, '(\d+)$', 1) AS INTEGER)"
ORACLE["registered_devices"] = with_tele() + f"""
SELECT {READING_COLS} FROM readings WHERE {_MACHINE_NO} % 6 <> 0"""
ORACLE["unregistered_devices"] = with_tele() + f"""
SELECT {READING_COLS} FROM readings WHERE machine_id IS NULL OR {_MACHINE_NO} % 6 = 0"""

ORACLE["raw_rows_by_partition"] = with_tele() + """
SELECT CAST(event_time AS DATE) AS date, machine_id, count(*) AS "rows"
FROM readings WHERE event_time IS NOT NULL AND machine_id IS NOT NULL
GROUP BY 1, 2"""

ALERTS = f"""
lagged AS (
  SELECT *, lag(health_status) OVER (PARTITION BY machine_id ORDER BY window_end) AS prev FROM windows
),
alerts AS (
  SELECT l.machine_id, l.window_end AS triggered_at,
         'max_vibration=' || {fixed('l.max_vibration', 2)} || ', max_temp=' || {fixed('l.max_temp', 1)} AS reason,
         EXISTS (SELECT 1 FROM windows w WHERE w.machine_id = l.machine_id AND w.health_status = 'OK'
                 AND w.window_end > l.window_end) AS resolved
  FROM lagged l
  WHERE l.health_status = 'ALERT' AND (l.prev IS NULL OR l.prev = 'OK')
)"""

ORACLE["alert_lifecycle"] = with_tele(WINDOWS, ALERTS) + "\nSELECT * FROM alerts"
ORACLE["alert_lifecycle_incremental"] = ORACLE["alert_lifecycle"]
ORACLE["alert_lifecycle_shuffled"] = ORACLE["alert_lifecycle"]
ORACLE["open_alerts"] = with_tele(WINDOWS, ALERTS) + "\nSELECT machine_id, triggered_at, reason FROM alerts WHERE NOT resolved"
ORACLE["raw_mixed_writers"] = ORACLE["raw_rows_by_partition"]
ORACLE["alert_feed"] = ORACLE["alert_lifecycle"]
ORACLE["status_feed"] = ORACLE["window_status"]
ORACLE["unresolved_alerts"] = with_tele(WINDOWS, ALERTS) + """
SELECT count(*) FILTER (WHERE NOT resolved) AS unresolved FROM alerts"""

LATEST = """
latest AS (
  SELECT * FROM windows QUALIFY row_number() OVER (PARTITION BY machine_id ORDER BY window_end DESC) = 1
)"""
ORACLE["latest_status"] = with_tele(WINDOWS, LATEST) + "\nSELECT * FROM latest"
ORACLE["status_grid"] = with_tele(WINDOWS, LATEST) + f"""
SELECT machine_id, health_status,
       CASE WHEN avg_vibration IS NOT NULL
            THEN {fixed('avg_temp', 1)} || '°C / vib ' || {fixed('avg_vibration', 2)}
            ELSE {fixed('avg_temp', 1)} || '°C' END AS label
FROM latest"""

ORACLE["validation_summary"] = with_tele() + f"""
SELECT count(*) AS rows_validated, count(*) FILTER (WHERE {INCOMPLETE}) AS rows_quarantined FROM readings"""
ORACLE["valid_rows"] = with_tele() + f"\nSELECT {READING_COLS} FROM readings WHERE NOT {INCOMPLETE}"
ORACLE["quarantine_rows"] = with_tele() + f"\nSELECT {READING_COLS} FROM readings WHERE {INCOMPLETE}"


def dedup_cte(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT {READING_COLS} FROM {source}
  WHERE machine_id IS NOT NULL AND event_time IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY machine_id, date_trunc('minute', event_time)
                             ORDER BY event_time DESC, event_id DESC) = 1
)"""


def daily_cte(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT machine_id, date, total_readings, anomaly_count, avg_daily_temp, avg_daily_vibration,
         1 - anomaly_count / total_readings AS uptime_score
  FROM (
    SELECT machine_id, CAST(event_time AS DATE) AS date, count(*) AS total_readings,
           count(*) FILTER (WHERE coalesce(temperature > 90, false) OR coalesce(vibration > 1.8, false))
             AS anomaly_count,
           {mean('temperature')} AS avg_daily_temp,
           {mean('vibration')} AS avg_daily_vibration
    FROM {source} GROUP BY 1, 2)
)"""


VALID = f"valid AS (SELECT * FROM readings WHERE NOT {INCOMPLETE})"
DAILY_ALL = (dedup_cte("dedup_all", "readings"), daily_cte("daily_all", "dedup_all"))
DAILY_GATED = (VALID, dedup_cte("dedup_valid", "valid"), daily_cte("daily_gated", "dedup_valid"))

ORACLE["dedup_latest_per_minute"] = with_tele(DAILY_ALL[0]) + "\nSELECT * FROM dedup_all"
ORACLE["daily_reliability"] = with_tele(*DAILY_ALL) + "\nSELECT * FROM daily_all"
ORACLE["daily_reliability_gated"] = with_tele(*DAILY_GATED) + "\nSELECT * FROM daily_gated"
ORACLE["gold_upsert"] = with_tele(*DAILY_ALL, *DAILY_GATED) + """
SELECT * FROM daily_all WHERE date <> DATE '2024-01-02'
UNION ALL
SELECT * FROM daily_gated WHERE date = DATE '2024-01-02'"""
ORACLE["uptime_trend_pivot"] = with_tele(*DAILY_GATED) + "\nSELECT date, " + ", ".join(
    f"avg(uptime_score) FILTER (WHERE machine_id = 'machine-0{n}') AS \"machine-0{n}\"" for n in range(1, 7)
) + "\nFROM daily_gated GROUP BY date"

ORACLE["uptime_trend"] = with_tele(*DAILY_GATED) + "\nSELECT date, machine_id, uptime_score FROM daily_gated"
ORACLE["gold_display"] = with_tele(*DAILY_GATED) + "\nSELECT * FROM daily_gated"

SERIES = """
series AS (
  SELECT machine_id, event_time, event_id, vibration FROM readings
  WHERE machine_id IS NOT NULL AND event_time IS NOT NULL AND vibration IS NOT NULL
)"""
ORACLE["rate_of_change"] = with_tele(SERIES) + """,
steps AS (
  SELECT *, lag(vibration) OVER w AS prev_vibration, lag(event_time) OVER w AS prev_time
  FROM series WINDOW w AS (PARTITION BY machine_id ORDER BY event_time, event_id)
)
SELECT machine_id, event_time, event_id, vibration, prev_vibration,
       vibration - prev_vibration AS delta_vibration,
       (vibration - prev_vibration) / (CAST(epoch_us(event_time) - epoch_us(prev_time) AS DOUBLE) / 1000000)
         AS rate_per_s
FROM steps
WHERE prev_vibration IS NOT NULL AND epoch_us(event_time) > epoch_us(prev_time)
  AND abs(vibration - prev_vibration) > 1.0"""

ORACLE["zscore_anomaly"] = with_tele(SERIES) + """,
framed AS (
  SELECT *, count(vibration) OVER w AS n, avg(vibration) OVER w AS mean, stddev_samp(vibration) OVER w AS sd
  FROM series
  WINDOW w AS (PARTITION BY machine_id ORDER BY event_time, event_id ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)
)
SELECT machine_id, event_time, event_id, vibration, round(mean, 6) AS mean_vibration, round(sd, 6) AS std_vibration,
       round(abs(vibration - mean) / sd, 6) AS zscore
FROM framed
WHERE n = 30 AND sd > 0 AND abs(vibration - mean) / sd > 3.0"""

ORACLE["typed_thresholds"] = with_tele() + f""",
typed AS (
  SELECT *, CASE {_MACHINE_NO} % 3 WHEN 1 THEN 'press' WHEN 2 THEN 'lathe' ELSE 'pump' END AS mtype
  FROM readings
),
limits(machine_type, vib_limit, temp_limit) AS (
  VALUES ('press', CAST(2.0 AS DOUBLE), CAST(95.0 AS DOUBLE)), ('lathe', CAST(1.5 AS DOUBLE), CAST(85.0 AS DOUBLE))
)
SELECT r.machine_id, r.event_time, r.temperature, r.vibration, r.rpm, r.status, r.event_id,
       CASE WHEN r.machine_id IS NULL THEN NULL ELSE r.mtype END AS machine_type,
       coalesce(l.vib_limit, CAST(1.8 AS DOUBLE)) AS vib_limit,
       coalesce(l.temp_limit, CAST(90.0 AS DOUBLE)) AS temp_limit,
       coalesce(r.temperature > coalesce(l.temp_limit, 90.0), false)
         OR coalesce(r.vibration > coalesce(l.vib_limit, 1.8), false) AS is_anomaly
FROM typed r LEFT JOIN limits l ON l.machine_type = r.mtype AND r.machine_id IS NOT NULL"""

# A stream emits a window once the watermark (newest shifted event time in
# whole milliseconds, minus the 5 s tolerance) has passed its end.
EMITTED = """
emitted AS (
  SELECT * FROM windows
  WHERE window_end <= (SELECT date_trunc('millisecond', max(event_time) - INTERVAL 1 MICROSECOND)
                              - INTERVAL 5 SECOND FROM readings WHERE machine_id IS NOT NULL)
)"""
ORACLE["stream_window_status"] = with_tele(WINDOWS, EMITTED) + "\nSELECT * FROM emitted"
ORACLE["stream_window_status_complete"] = ORACLE["window_status"]
ORACLE["stream_alert_lifecycle"] = with_tele(WINDOWS, EMITTED, ALERTS.replace("FROM windows", "FROM emitted")) + \
    "\nSELECT * FROM alerts"
ORACLE["stream_raw_rows_by_partition"] = ORACLE["raw_rows_by_partition"]

RAW_ZONE = "raw_zone AS (SELECT * FROM readings WHERE event_time IS NOT NULL AND machine_id IS NOT NULL)"
ORACLE["validation_by_partition"] = with_tele(RAW_ZONE) + f"""
SELECT CAST(event_time AS DATE) AS date, machine_id, count(*) AS "rows",
       count(*) FILTER (WHERE {INCOMPLETE}) AS rows_quarantined,
       concat_ws(',', {", ".join(f"CASE WHEN count({c}) = 0 THEN '{c}' END" for c in REQUIRED)}) AS missing_columns
FROM raw_zone GROUP BY 1, 2"""
ORACLE["nightly_counts"] = with_tele(RAW_ZONE) + f"""
SELECT 'success' AS status, count(*) AS rows_validated, count(*) FILTER (WHERE {INCOMPLETE}) AS rows_quarantined
FROM raw_zone
UNION ALL
SELECT 'skipped_no_new_files', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)"""
ORACLE["nightly_clean"] = ORACLE["daily_reliability_gated"]
ORACLE["nightly_missing_columns"] = with_tele(RAW_ZONE) + """
SELECT count(*) AS "rows", count(*) AS rows_quarantined FROM raw_zone WHERE event_id % 3 = 0"""
ORACLE["nightly_quarantine"] = with_tele(RAW_ZONE) + f"""
SELECT CAST(event_time AS DATE) AS date, count(*) AS "rows" FROM raw_zone WHERE {INCOMPLETE} GROUP BY 1"""

ADJUSTED = """
adjusted AS (
  SELECT coalesce(nullif(body_machine_id, ''), device_id) AS machine_id,
         CASE WHEN event_time IS NULL THEN NULL
              ELSE greatest(event_time, enqueued_at - INTERVAL 5 SECOND) END AS event_time,
         temperature, vibration, rpm, status, event_id
  FROM tele
)"""
ORACLE["window_status_adjusted"] = with_tele(ADJUSTED, WINDOWS.replace("FROM readings", "FROM adjusted")) + \
    "\nSELECT * FROM windows"
