"""Telemetry derived from the driver's ``events`` table.

The test tables hold no machine readings, so readings are derived from
``events`` with integer-only steps (FIXTURES.md section 4); the same
derivation is written in SQL for the oracle.  Work grows with ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rotorwatch.config import CONTENT_TYPE, prepare
from rotorwatch.schemas import BODY

# Fixed values of the derivation (FIXTURES.md section 4).
BASE_US = 1704067200000000  # 2024-01-01 00:00:00 UTC in microseconds
TAIL_FROM_US = 1706486400000000  # machine-06 runs hot from here on
SQUEEZE = 15  # 30 days of events squeezed into 48 hours
EDGE_US = 300000000  # 5 minutes
SIX_MACHINES = 6


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's events table."""
    return prepare(spark).read.parquet(f"{sf_dir}/events.parquet")


def _device(user_id: Column, machines: str) -> Column:
    if machines == "six":
        return F.concat(F.lit("machine-0"), (user_id % SIX_MACHINES + 1).cast("string"))
    # one machine per user id: many machines so work spreads over tasks
    return F.concat(F.lit("machine-"), F.lpad(user_id.cast("string"), 5, "0"))


def telemetry_columns(ev: DataFrame, machines: str = "six") -> DataFrame:
    """Flat telemetry columns: event_id, device_id, body_machine_id, event_time,
    temperature, vibration, rpm, status, enqueued_at."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    k = F.get_json_object("props", "$.k").cast("long")
    c = F.round(F.col("value") * 100).cast("long") % 1500
    anom = F.col("event_id") % 20 == 0
    tail = (F.col("user_id") % SIX_MACHINES == 5) & (us >= F.lit(TAIL_FROM_US))
    cus = F.lit(BASE_US) + F.expr(f"(unix_micros(cast(ts as timestamp)) - {BASE_US}) div {SQUEEZE}")
    eid = F.col("event_id")
    device = _device(F.col("user_id"), machines)
    event_us = (F.when(eid % 307 == 5, F.lit(None).cast("long"))
                .when(eid % 97 == 0, F.expr(f"_cus div {EDGE_US}") * EDGE_US)
                .otherwise(F.col("_cus")))
    temp_cents = (F.lit(6000) + F.col("_c") + F.when(F.col("_anom"), 1500 + F.col("_c")).otherwise(0)
                  + F.when(F.col("_tail"), 4000).otherwise(0))
    vib_milli = (F.lit(200) + (F.col("_k") % 60) * 10 + F.when(F.col("_anom"), 1500 + F.col("_c")).otherwise(0))
    return (
        ev.select(eid, device.alias("device_id"), c.alias("_c"), anom.alias("_anom"), tail.alias("_tail"),
                  cus.alias("_cus"), k.alias("_k"))
        .select(
            "event_id",
            "device_id",
            F.when(eid % 211 == 0, F.lit("")).otherwise(F.col("device_id")).alias("body_machine_id"),
            F.timestamp_micros(event_us).alias("event_time"),
            (temp_cents.cast("double") / 100).alias("temperature"),
            F.when(eid % 50 == 7, F.lit(None).cast("double")).otherwise(vib_milli.cast("double") / 1000)
            .alias("vibration"),
            (F.lit(1200) + F.col("_k") * 6).cast("double").alias("rpm"),
            F.when(F.col("_anom") | F.col("_tail"), F.lit("warning")).otherwise(F.lit("running")).alias("status"),
            # the hub stamps arrival one second after the device clock
            F.timestamp_micros(F.col("_cus") + 1000000).alias("enqueued_at"),
        )
    )


def iso_utc(ts: Column) -> Column:
    """ISO-8601 UTC text like a device clock writes it: the fraction is left out
    when it is zero, and ``+00:00`` is the offset."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, ".SSSSSS")
    return F.concat(whole, F.when(F.unix_micros(ts) % 1000000 == 0, F.lit("")).otherwise(frac), F.lit("+00:00"))


def telemetry_envelopes(ev: DataFrame, machines: str = "six") -> DataFrame:
    """Envelope rows (device_id, enqueued_time, content_type, body) plus event_id
    as the message offset.  A missing event time is sent as unparseable text so
    that it does not fall back to the enqueue time."""
    return envelopes_from_columns(telemetry_columns(ev, machines))


def envelopes_from_columns(t: DataFrame, *extra: str) -> DataFrame:
    """Envelope rows from :func:`telemetry_columns` output, keeping ``extra`` columns."""
    body = F.struct(
        F.col("body_machine_id").alias("machine_id"),
        F.coalesce(iso_utc(F.col("event_time")), F.lit("garbage")).alias("timestamp"),
        "temperature", "vibration", "rpm", "status",
    ).cast(BODY)
    return t.select("event_id", "device_id", iso_utc(F.col("enqueued_at")).alias("enqueued_time"),
                    F.lit(CONTENT_TYPE).alias("content_type"), body.alias("body"), *extra)


def readings_from_events(ev: DataFrame, machines: str = "six") -> DataFrame:
    """Parsed readings: machine_id, event_time, temperature, vibration, rpm, status, event_id."""
    t = telemetry_columns(ev, machines)
    return t.select(
        F.coalesce(F.nullif("body_machine_id", F.lit("")), F.col("device_id")).alias("machine_id"),
        "event_time", "temperature", "vibration", "rpm", "status", "event_id",
    )


def telemetry_readings(spark: SparkSession, sf_dir: str, machines: str = "six") -> DataFrame:
    """Readings of the telemetry view over ``events`` (see :func:`readings_from_events`)."""
    return readings_from_events(events(spark, sf_dir), machines)
