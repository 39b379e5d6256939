"""Alert lifecycle over status windows.

Per machine, windows are taken in window_end order.  An ALERT window opens an
alert when the machine has none open, i.e. when the previous window with data
was OK or there was none; an OK window resolves the open alert.  The same step
serves the whole history, a batch, and a stream's micro-batch: what earlier
windows have left behind is the machine's open alert.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rotorwatch.functions import alert_id, alert_reason


def alert_lifecycle(status: DataFrame) -> DataFrame:
    """alert_id, machine_id, triggered_at, reason, resolved: the alerts of a whole history."""
    return alert_changes(status).drop("resolved_at")


def alert_changes(status: DataFrame, open_alerts: DataFrame | None = None) -> DataFrame:
    """alert_id, machine_id, triggered_at, reason, resolved, resolved_at.

    ``open_alerts`` (rows of the alert table) go before the windows of their
    machine, as the ALERT window that opened them, and come back in the result,
    resolved or still open.  The status table has one row per machine and
    five-minute window, so the per-machine ordering is over windows (bounded by
    time span), not readings.  Both window functions share the machine
    partitioning: one shuffle, one pass over the windows.  An alert is resolved
    by the first OK window of its machine that comes after it.
    """
    windows = status.select("machine_id", "window_end", "health_status", alert_reason("max_vibration", "max_temp").alias("reason"),
                            F.lit(1).alias("_new"))
    if open_alerts is not None:
        # a window of the same time is that alert's own, written before
        windows = windows.unionByName(open_alerts.select(
            "machine_id", F.col("triggered_at").alias("window_end"), F.lit("ALERT").alias("health_status"), "reason",
            F.lit(0).alias("_new")))
    in_order = Window.partitionBy("machine_id").orderBy("window_end", "_new")
    later = in_order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    marked = windows.select(
        "*",
        F.lag("health_status").over(in_order).alias("_prev"),
        F.min(F.when(F.col("health_status") == "OK", F.col("window_end"))).over(later).alias("resolved_at"),
    )
    opened = marked.filter((F.col("health_status") == "ALERT")
                           & (F.col("_prev").isNull() | (F.col("_prev") == "OK")))
    return opened.select(alert_id("machine_id", "window_end").alias("alert_id"),
                         "machine_id",
                         F.col("window_end").alias("triggered_at"),
                         "reason",
                         F.col("resolved_at").isNotNull().alias("resolved"), "resolved_at")
