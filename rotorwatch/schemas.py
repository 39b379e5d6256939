"""Declared schemas.  Parsing is permissive; validation enforces completeness."""

from pyspark.sql import types as T

# Device payload.  rpm is parsed as DOUBLE: a whole-number field typed BIGINT
# turns "1300.0" into a corrupt record.
BODY = T.StructType([
    T.StructField("machine_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("vibration", T.DoubleType()),
    T.StructField("rpm", T.DoubleType()),
    T.StructField("status", T.StringType()),
])

CORRUPT_COLUMN = "_corrupt_record"

# One message line: envelope around the payload.
ENVELOPE = T.StructType([
    T.StructField("device_id", T.StringType()),
    T.StructField("enqueued_time", T.StringType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("body", BODY),
])

# Parsed reading, also the raw-zone file schema (partition columns excluded).
READING_COLUMNS = ("machine_id", "event_time", "temperature", "vibration", "rpm", "status")
READING = T.StructType([
    T.StructField("machine_id", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("vibration", T.DoubleType()),
    T.StructField("rpm", T.DoubleType()),
    T.StructField("status", T.StringType()),
])

# Raw zone: reading columns plus the message offset used as a tie-breaker,
# partitioned by UTC date and machine.
RAW_FILE = T.StructType(READING.fields + [T.StructField("event_id", T.LongType())])
RAW = T.StructType(RAW_FILE.fields + [
    T.StructField("date", T.DateType()),
])

QUARANTINE = T.StructType(RAW_FILE.fields + [
    T.StructField("source_file", T.StringType()),
    T.StructField("date", T.DateType()),
])

STATUS = T.StructType([
    T.StructField("machine_id", T.StringType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("avg_temp", T.DoubleType()),
    T.StructField("max_temp", T.DoubleType()),
    T.StructField("avg_vibration", T.DoubleType()),
    T.StructField("max_vibration", T.DoubleType()),
    T.StructField("health_status", T.StringType()),
])

ALERT = T.StructType([
    T.StructField("alert_id", T.LongType()),
    T.StructField("machine_id", T.StringType()),
    T.StructField("triggered_at", T.TimestampType()),
    T.StructField("reason", T.StringType()),
    T.StructField("resolved", T.BooleanType()),
])

GOLD = T.StructType([
    T.StructField("machine_id", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("total_readings", T.LongType()),
    T.StructField("anomaly_count", T.LongType()),
    T.StructField("avg_daily_temp", T.DoubleType()),
    T.StructField("avg_daily_vibration", T.DoubleType()),
    T.StructField("uptime_score", T.DoubleType()),
])

RUN_LOG = T.StructType([
    T.StructField("started_at", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("files_seen", T.LongType()),
    T.StructField("rows_validated", T.LongType()),
    T.StructField("rows_quarantined", T.LongType()),
])

THRESHOLD = T.StructType([
    T.StructField("machine_type", T.StringType()),
    T.StructField("vib_limit", T.DoubleType()),
    T.StructField("temp_limit", T.DoubleType()),
])
