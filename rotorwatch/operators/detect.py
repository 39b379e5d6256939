"""Documented-only detectors (R1, R2, R3).  The reference names them in its
design notes but implements none; the definitions below are ours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotorwatch.config import DEFAULT, Settings
from rotorwatch.operators.joins import measured
from rotorwatch.operators.sequence import CARRY, rank_buckets, frame, with_preceding

KEYS = ["machine_id"]
ORDER = ["event_time", "event_id"]


def _vibration_series(readings: DataFrame, cfg: Settings) -> DataFrame:
    """Readings with machine, time and vibration, in buckets of consecutive
    readings, ``sequence_bucket_rows`` of them at most (``_rank_bucket``)."""
    series = (readings
              .filter(F.col("machine_id").isNotNull() & F.col("event_time").isNotNull()
                      & F.col("vibration").isNotNull())
              .select("machine_id", "event_time", "event_id", "vibration"))
    return rank_buckets(series, KEYS, ORDER, cfg.sequence_bucket_rows)


def rate_of_change(readings: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """Readings whose vibration moved more than ``roc_limit`` since the
    machine's previous reading (same order: event_time, event_id).

    Reports delta and delta per second; a zero time step is not scored.
    """
    framed = with_preceding(_vibration_series(readings, cfg), KEYS, ORDER, "_rank_bucket", 1)
    w = frame(KEYS, ORDER)
    prev_v = F.lag("vibration").over(w)
    prev_t = F.lag("event_time").over(w)
    steps = (framed
             .select("machine_id", "event_time", "event_id", "vibration", CARRY,
                     prev_v.alias("prev_vibration"),
                     ((F.unix_micros("event_time") - F.unix_micros(prev_t)).cast("double") / 1000000)
                     .alias("_dt"))
             .filter(~F.col(CARRY) & F.col("prev_vibration").isNotNull()))
    delta = F.col("vibration") - F.col("prev_vibration")
    return (steps
            .filter((F.col("_dt") > 0) & (F.abs(delta) > F.lit(cfg.roc_limit)))
            .select("machine_id", "event_time", "event_id", "vibration", "prev_vibration",
                    delta.alias("delta_vibration"), (delta / F.col("_dt")).alias("rate_per_s")))


def zscore_anomaly(readings: DataFrame, cfg: Settings = DEFAULT) -> DataFrame:
    """R2: |x - mean| / stddev_samp over the machine's ``zscore_window``
    preceding readings above ``zscore_k``; only with a full window and a
    positive spread.

    The frame is a sliding one in double precision: mean and spread are merged
    stably, so no digit is dropped, no finite value overflows a decimal, and
    large values with a small spread do not cancel, as differences of running
    sums would.
    """
    n = cfg.zscore_window
    framed = with_preceding(_vibration_series(readings, cfg), KEYS, ORDER, "_rank_bucket", n)
    before = frame(KEYS, ORDER).rowsBetween(-n, -1)
    scored = framed.select("machine_id", "event_time", "event_id", "vibration", CARRY,
                           F.count("vibration").over(before).alias("_n"),
                           F.avg("vibration").over(before).alias("mean_vibration"),
                           F.stddev_samp("vibration").over(before).alias("std_vibration"))
    z = F.abs(F.col("vibration") - F.col("mean_vibration")) / F.col("std_vibration")
    return (scored.filter(~F.col(CARRY) & (F.col("_n") == n) & (F.col("std_vibration") > 0))
            .select("machine_id", "event_time", "event_id", "vibration", "mean_vibration", "std_vibration",
                    z.alias("zscore"))
            .filter(F.col("zscore") > F.lit(cfg.zscore_k)))


def apply_thresholds(readings: DataFrame, machines: DataFrame, thresholds: DataFrame,
                     default_vib: float, default_temp: float) -> DataFrame:
    """Anomaly flag with limits per machine type.

    ``machines`` maps machine_id -> machine_type; ``thresholds`` maps
    machine_type -> (vib_limit, temp_limit).  Machines without a type, or a
    type without limits, use the default limits.  The limits are joined to the
    machines first, and the one dimension that results is broadcast by its
    measured size (see ``joins.measured``).
    """
    typed = (machines.select("machine_id", "machine_type")
             .join(thresholds.select("machine_type", "vib_limit", "temp_limit"), "machine_type", "left"))
    limits = readings.join(measured(typed.select("machine_id", "machine_type", "vib_limit", "temp_limit")),
                           "machine_id", "left")
    vib = F.coalesce(F.col("vib_limit"), F.lit(default_vib))
    temp = F.coalesce(F.col("temp_limit"), F.lit(default_temp))
    anomalous = (F.coalesce(F.col("temperature") > temp, F.lit(False))
                 | F.coalesce(F.col("vibration") > vib, F.lit(False)))
    return limits.select(*readings.columns, "machine_type", vib.alias("vib_limit"), temp.alias("temp_limit"),
                         anomalous.alias("is_anomaly"))
