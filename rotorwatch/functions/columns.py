"""Column expressions shared by batch and streaming operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_present(primary: str | Column, fallback: str | Column) -> Column:
    """First non-empty value: an empty string counts as missing."""
    return F.coalesce(F.nullif(col(primary), F.lit("")), col(fallback))


def safe_timestamp(text: str | Column) -> Column:
    """ISO-8601 text (offset and fraction optional) to TIMESTAMP; bad text -> null.

    Each value is parsed on its own, so one row's format never affects another.
    """
    return F.try_to_timestamp(col(text))


def finite_or_null(c: str | Column) -> Column:
    """A measurement that is NaN or infinite counts as missing: ``NaN > x`` is true in Spark, and one infinite value would make
    an average infinite or NaN."""
    c = col(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


def adjusted_time(event_time: str | Column, arrival: str | Column, tolerance: str) -> Column:
    """Late-arrival "adjust" policy: a time more than ``tolerance`` before its
    arrival becomes arrival - tolerance; a missing time stays missing."""
    floor = col(arrival) - F.expr(f"INTERVAL {tolerance}")
    # greatest() skips a null floor, so a missing arrival keeps the event time
    return F.when(col(event_time).isNotNull(), F.greatest(col(event_time), floor))


def shifted_event_time(ts: str | Column = "event_time") -> Column:
    """Event time moved back by 1 µs so Spark's [start, end) windows become (start, end]."""
    return col(ts) - F.expr("INTERVAL '0.000001' SECOND")


def health_status(max_vibration: str | Column, max_temp: str | Column,
                  vib_limit: float, temp_limit: float) -> Column:
    """ALERT when a maximum is strictly above its limit; null maxima never alert."""
    return (F.when((col(max_vibration) > F.lit(vib_limit)) | (col(max_temp) > F.lit(temp_limit)), F.lit("ALERT"))
            .otherwise(F.lit("OK")))


def reading_anomaly(temperature: str | Column, vibration: str | Column,
                    temp_limit: float, vib_limit: float) -> Column:
    """Reading-level anomaly; a null measurement is not anomalous (never null)."""
    return F.coalesce(col(temperature) > F.lit(temp_limit), F.lit(False)) | \
        F.coalesce(col(vibration) > F.lit(vib_limit), F.lit(False))


def fixed_decimals(c: str | Column, digits: int, missing: str = "nan") -> Column:
    """Number of any size as text with ``digits`` decimals, rounded half-up on the decimal value."""
    return F.when(col(c).isNotNull(), F.format_string(f"%.{digits}f", col(c))).otherwise(F.lit(missing))


def alert_reason(max_vibration: str | Column, max_temp: str | Column) -> Column:
    """``max_vibration=<2 dp>, max_temp=<1 dp>``; a missing value reads ``nan``."""
    return F.concat(F.lit("max_vibration="), fixed_decimals(max_vibration, 2),
                    F.lit(", max_temp="), fixed_decimals(max_temp, 1))


def status_label(avg_temp: str | Column, avg_vibration: str | Column) -> Column:
    """Dashboard tile text; the vibration part is left out when it is null."""
    temp = F.concat(fixed_decimals(avg_temp, 1), F.lit("°C"))
    return F.when(col(avg_vibration).isNotNull(),
                  F.concat(temp, F.lit(" / vib "), fixed_decimals(avg_vibration, 2))).otherwise(temp)


def any_null(columns) -> Column:
    """True when any of the columns is null."""
    return reduce(lambda a, b: a | b, [col(c).isNull() for c in columns])


def alert_id(machine_id: str | Column, triggered_at: str | Column) -> Column:
    """Stable alert key: the same alert gets the same id on every retry or rerun."""
    return F.xxhash64(col(machine_id), col(triggered_at))
