"""Five-minute right-closed status windows.

The same functions serve batch and streaming: a stream adds the watermark on
``_wt`` between :func:`with_window_time` and :func:`window_parts`, and joins the
parts of its closed windows in each micro-batch (:func:`windows_of_parts`).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotorwatch.config import DEFAULT, Settings, duration
from rotorwatch.functions import health_status, partial_means, shifted_event_time, whole_mean

WINDOW_TIME = "_wt"


def with_window_time(readings: DataFrame) -> DataFrame:
    """Drop readings without time or machine and add the shifted window time.

    ``_wt = event_time - 1 µs`` turns Spark's [start, end) windows into the
    reference's (start, end]: a reading at exactly 12:05:00 closes the window
    ending 12:05.  In a stream the watermark must be put on ``_wt``.
    """
    return (readings
            .filter(F.col("event_time").isNotNull() & F.col("machine_id").isNotNull())
            .withColumn(WINDOW_TIME, shifted_event_time("event_time")))


def with_window(readings_wt: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """Adds each reading's window, ``w``."""
    return readings_wt.withColumn("w", F.window(WINDOW_TIME, cfg.window))


def window_parts(readings_wt: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """Per (machine_id, window), and per magnitude of the measurements: sums that
    make exact averages, and maxima.

    Partial aggregation runs before the shuffle, so a machine with a huge share
    of readings still sends one partial row per window per map task.  A window
    has one part, or two where a measurement crosses a power of 2 ** 28, in
    practice; all of them close at once.
    """
    if "w" not in readings_wt.columns:
        readings_wt = with_window(readings_wt, cfg)
    parts = partial_means(readings_wt, ["machine_id", "w"],
                          {"temperature": "avg_temp", "vibration": "avg_vibration"},
                          F.max("temperature").alias("max_temp"), F.max("vibration").alias("max_vibration"))
    return parts.select("machine_id", F.col("w.end").alias("window_end"), "avg_temp", "max_temp", "avg_vibration", "max_vibration")


def windows_of_parts(parts: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """Per (machine_id, window): avg/max temperature and vibration, health status."""
    agg = parts.groupBy("machine_id", "window_end").agg(
        whole_mean("avg_temp").alias("avg_temp"), F.max("max_temp").alias("max_temp"),
        whole_mean("avg_vibration").alias("avg_vibration"), F.max("max_vibration").alias("max_vibration"))
    return agg.select(
        "machine_id", "window_end", "avg_temp", "max_temp", "avg_vibration", "max_vibration",
        health_status("max_vibration", "max_temp", cfg.window_vib_limit, cfg.window_temp_limit)
        .alias("health_status"),
    )


def window_status(readings: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """machine_status rows for every window that has at least one timed reading."""
    return windows_of_parts(window_parts(with_window_time(readings), cfg), cfg)


def _window_floor(ts: dt.datetime, cfg: Settings) -> dt.datetime:
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    step = duration(cfg.window)
    return epoch + ((ts - epoch) // step) * step


def closed_windows(readings: DataFrame, as_of: dt.datetime, cfg: Settings = DEFAULT) -> DataFrame:
    """Windows whose end is at least the tolerance before ``as_of``.

    ``window_end <= cutoff`` is the same as ``event_time <= floor(cutoff)``, so
    readings of still-open windows are dropped before the shuffle.
    """
    aware = as_of if as_of.tzinfo else as_of.replace(tzinfo=dt.timezone.utc)
    cutoff = aware - duration(cfg.tolerance)
    last_edge = _window_floor(cutoff, cfg)
    early = readings.filter(F.col("event_time") <= F.lit(last_edge))
    return window_status(early, cfg).filter(F.col("window_end") <= F.lit(cutoff))
