"""Dashboard reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rotorwatch.functions import status_label


def latest_status(status: DataFrame) -> DataFrame:
    """The last window of every machine (ties cannot occur: one row per window)."""
    last = Window.partitionBy("machine_id").orderBy(F.col("window_end").desc())
    return status.withColumn("_rn", F.row_number().over(last)).filter(F.col("_rn") == 1).drop("_rn")


def status_grid(status: DataFrame) -> DataFrame:
    """Tile per machine: health status and the ``71.2°C / vib 0.45`` label, by machine."""
    return (latest_status(status)
            .select("machine_id", "health_status", status_label("avg_temp", "avg_vibration").alias("label"))
            .orderBy("machine_id"))


def unresolved_count(alerts: DataFrame) -> DataFrame:
    """One row: number of alerts still open."""
    return alerts.agg(F.count_if(~F.col("resolved")).alias("unresolved"))


def alert_feed(alerts: DataFrame) -> DataFrame:
    """Alerts newest first (ordering for presentation only)."""
    return alerts.orderBy(F.col("triggered_at").desc(), F.col("machine_id"))


def status_feed(status: DataFrame) -> DataFrame:
    """Status rows newest first."""
    return status.orderBy(F.col("window_end").desc(), F.col("machine_id"))


def uptime_trend(gold: DataFrame) -> DataFrame:
    """Mean uptime_score per date and machine, for all machines, in display
    order: the long form of the trend, of any number of machines."""
    return (gold.groupBy("date", "machine_id").agg(F.avg("uptime_score").alias("uptime_score"))
            .orderBy("date", "machine_id"))


def gold_display(gold: DataFrame) -> DataFrame:
    """Gold rows in display order."""
    return gold.orderBy("date", "machine_id")


# A pivot has a column per machine; beyond this many it is no table to look at.
PIVOT_MACHINES = 1_000


def uptime_pivot(gold: DataFrame, machines: list[str] | None = None) -> DataFrame:
    """date x machine_id table of mean uptime_score: of the machines passed in,
    or of all in ``gold``.  With more than ``PIVOT_MACHINES`` it refuses;
    :func:`uptime_trend` has no such bound."""
    if machines is None:
        found = gold.select("machine_id").distinct().limit(PIVOT_MACHINES + 1).collect()
        if len(found) > PIVOT_MACHINES:
            raise ValueError(f"more than {PIVOT_MACHINES} machines: use uptime_trend")
        machines = sorted(r["machine_id"] for r in found if r["machine_id"] is not None)
    return gold.groupBy("date").pivot("machine_id", machines).agg(F.avg("uptime_score")).orderBy("date")


def partition_counts(readings: DataFrame) -> DataFrame:
    """Rows per raw-zone partition (UTC date, machine_id)."""
    return readings.groupBy("date", "machine_id").agg(F.count(F.lit(1)).alias("rows"))
