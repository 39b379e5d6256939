"""Message decoding and encoding, device check."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rotorwatch.config import CONTENT_TYPE, DEFAULT, Settings
from rotorwatch.functions import adjusted_time, first_present, finite_or_null, safe_timestamp
from rotorwatch.operators.joins import measured
from rotorwatch.schemas import BODY, CORRUPT_COLUMN, ENVELOPE, READING_COLUMNS

# the name of a member that no line can hold: it is drawn anew in each process
END = f"_end_{uuid.uuid4().hex}"
JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN, "allowNonNumericNumbers": "true"}


def envelope_to_reading(env: DataFrame, cfg: Settings = DEFAULT, keep: tuple[str, ...] = (), arrival: bool = False) -> DataFrame:
    """Envelope columns (device_id, enqueued_time, body.*) to reading columns.

    machine_id and the time text fall back to the envelope when the payload's
    value is missing or empty; time text that does not parse becomes null.
    With ``late_policy="adjust"`` the time is moved up to enqueue time minus
    the tolerance when it lags further behind.  ``arrival`` adds ``arrived_at``.
    """
    if cfg.time_source == "enqueued":
        time_text = F.col("enqueued_time")
    elif cfg.time_source == "device":
        time_text = first_present("body.timestamp", "enqueued_time")
    else:
        raise ValueError(f"time_source must be 'device' or 'enqueued', not {cfg.time_source!r}")
    event_time = safe_timestamp(time_text)
    if cfg.late_policy == "adjust":
        event_time = adjusted_time(event_time, safe_timestamp("enqueued_time"), cfg.tolerance)
    elif cfg.late_policy != "drop":
        raise ValueError(f"late_policy must be 'drop' or 'adjust', not {cfg.late_policy!r}")
    return env.select(
        first_present("body.machine_id", "device_id").alias("machine_id"),
        event_time.alias("event_time"),
        finite_or_null("body.temperature").alias("temperature"),
        finite_or_null("body.vibration").alias("vibration"),
        finite_or_null("body.rpm").alias("rpm"),
        F.col("body.status").alias("status"),
        *([safe_timestamp("enqueued_time").alias("arrived_at")] if arrival else []),
        *keep,
    )


def decode_lines(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON text in ``value`` to envelope columns, plus the line's text in
    ``_corrupt_record`` where it is anything but one JSON object.

    The line is parsed as the first of two members of an object, so whatever
    follows the first value breaks the object or hides its second member: JSON
    parsers stop after one value, and a second message on a line would vanish.
    Blank lines are skipped.

    Each line is parsed exactly once.  In a plain ``select``, Catalyst pushes
    every later filter (corrupt split, null time, null machine) below the
    projection and inlines ``from_json`` into it, so a line would be parsed
    once per filter plus once for the output.  Producing the message from a
    one-element ``inline`` keeps the parse in a Generate node, which those
    filters cannot pass.
    """
    line = F.concat(F.lit('{"_m":'), F.col("value"), F.lit(f',"{END}":1}}'))
    whole = T.StructType([T.StructField("_m", ENVELOPE), T.StructField(END, T.IntegerType()),
                          T.StructField(CORRUPT_COLUMN, T.StringType())])
    parsed = lines.select(*keep, "value", F.inline(F.array(F.struct(F.from_json(line, whole, JSON_OPTIONS).alias("_p")))))
    fine = F.col(f"_p.{CORRUPT_COLUMN}").isNull() & F.col("_p._m").isNotNull() & F.col(f"_p.{END}").isNotNull()
    return (parsed
            .filter(F.trim(F.regexp_replace("value", r"\s+", " ")) != "")
            .select(*keep, "_p._m.*", F.when(~fine, F.col("value")).alias(CORRUPT_COLUMN)))


def parse_envelopes(lines: DataFrame, cfg: Settings = DEFAULT,
                    keep: tuple[str, ...] = (), arrival: bool = False) -> tuple[DataFrame, DataFrame]:
    """Message lines -> (readings, corrupt lines).  Nothing is dropped silently:
    every non-blank line is in exactly one of the two outputs."""
    decoded = decode_lines(lines, keep)
    corrupt = decoded.filter(F.col(CORRUPT_COLUMN).isNotNull()).select(*keep, F.col(CORRUPT_COLUMN).alias("value"))
    good = decoded.filter(F.col(CORRUPT_COLUMN).isNull())
    return envelope_to_reading(good, cfg, keep, arrival), corrupt


def reading_payload(readings: DataFrame) -> DataFrame:
    """Readings back into envelope form: device_id = machine_id, body = reading."""
    body = F.struct(
        F.col("machine_id"),
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"),
        "temperature", "vibration", "rpm", "status",
    ).cast(BODY)
    return readings.select(F.col("machine_id").alias("device_id"),
                           F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("enqueued_time"),
                           F.lit(CONTENT_TYPE).alias("content_type"), body.alias("body"),
                           *[c for c in readings.columns if c not in READING_COLUMNS])


def encode_envelopes(env: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Envelope columns to one JSON line in ``value``.  A null field is left
    out of the JSON, like an absent key in the device payload."""
    msg = F.struct("device_id", "enqueued_time", "content_type", "body")
    return env.select(*keep, F.to_json(msg).alias("value"))


def split_registered(readings: DataFrame, devices: DataFrame, key: str = "machine_id") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): readings whose device is / is not registered.

    ``devices`` has ``device_id`` and ``registered``; it is broadcast by its
    measured size (see ``joins.measured``).
    """
    known = measured(devices.filter(F.col("registered")).select(F.col("device_id").alias(key)).distinct())
    return readings.join(known, key, "left_semi"), readings.join(known, key, "left_anti")


def with_registration(readings: DataFrame, history: DataFrame, at: str = "arrived_at", key: str = "machine_id") -> DataFrame:
    """``readings`` with ``registered``: whether the device was registered at the
    reading's time ``at``.

    ``history`` has ``device_id``, ``registered`` and ``valid_from``; a row holds
    until the device's next one, a null ``valid_from`` from ever on.  Of rows with
    one time the refusal counts, and a null ``registered`` is a refusal.  Devices
    without a row, rows before a device's first, and null times are not
    registered.  A device's periods are disjoint, so no reading is doubled.
    ``history`` is expected to be a table, by whose size Spark plans the join.
    """
    marks = (history.filter(F.col("device_id").isNotNull())
             .groupBy(F.col("device_id").alias("_device"),
                      F.coalesce("valid_from", F.lit("0001-01-01 00:00:00").cast("timestamp")).alias("_from"))
             .agg(F.min(F.coalesce("registered", F.lit(False))).alias("_registered")))
    ahead = Window.partitionBy("_device").orderBy("_from")
    periods = marks.withColumn("_to", F.lead("_from").over(ahead)).filter("_registered")
    within = ((F.col(key) == F.col("_device")) & (F.col(at) >= F.col("_from"))
              & (F.col("_to").isNull() | (F.col(at) < F.col("_to"))))
    return readings.join(periods, within, "left").select(*readings.columns, F.col("_device").isNotNull().alias("registered"))
