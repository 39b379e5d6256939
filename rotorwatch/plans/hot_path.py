"""Hot-path tables: machine_status and active_alerts.

The batch job and the stream's ``foreachBatch`` write through the same
functions, so both produce the same tables.  Both tables are merged on reading
(``sinks.deltas``): a micro-batch writes its own rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rotorwatch.config import drop_path, scratch_path
from rotorwatch.operators.alerts import alert_changes
from rotorwatch.schemas import ALERT, STATUS
from rotorwatch.sinks.deltas import DeltaTable
from rotorwatch.sources.raw import read_table

DATE = T.StructField("date", T.DateType())
STATUS_TABLE = T.StructType(STATUS.fields + [DATE])
# open alerts lie apart, under the date they were triggered; resolved ones under the date they were resolved
ALERT_TABLE = T.StructType(ALERT.fields + [T.StructField("resolved_at", T.TimestampType()), T.StructField("open", T.BooleanType()), DATE])


def status_table(spark: SparkSession, root: str) -> DeltaTable:
    return DeltaTable(spark, f"{root}/machine_status", STATUS_TABLE, ("machine_id", "window_end"), ("date",))


def alert_table(spark: SparkSession, root: str) -> DeltaTable:
    """Keyed by machine and time (an id is a hash and may collide)."""
    return DeltaTable(spark, f"{root}/active_alerts", ALERT_TABLE, ("machine_id", "triggered_at"), ("open", "date"))


def write_batch(spark: SparkSession, status: DataFrame, root: str) -> None:
    """The windows of a batch or micro-batch, new, late or corrected: status
    rows, then the alerts that follow from them.

    The windows are written first and read back, so they are computed once.
    A change in a window may move what comes after it, so each machine's
    alerts are derived again from its earliest window in the batch on: from the
    alert that was open then, and the status table's windows since.  Alerts
    that no longer follow are deleted, changed ones replaced, others left
    alone.  Whatever the order of batches, repeated and corrected ones
    included, the alerts are those of the status table's whole history.
    """
    path = scratch_path(spark, "windows")
    status.select(*STATUS.fieldNames()).write.parquet(path)
    new = read_table(spark, path, STATUS)
    try:
        bounds = new.agg(F.to_date(F.min("window_end")), F.count(F.lit(1)), F.count_distinct("machine_id", "window_end")).first()
        if bounds[0] is None:
            return
        if bounds[1] != bounds[2]:
            raise ValueError("a batch holds a window twice")
        status_table(spark, root).append(new.withColumn("date", F.to_date("window_end")))
        _write_alerts(spark, new.groupBy("machine_id").agg(F.min("window_end").alias("_first")), bounds[0], root, f"{path}-alerts")
    finally:
        drop_path(spark, path)
        drop_path(spark, f"{path}-alerts")


def _write_alerts(spark: SparkSession, changed: DataFrame, since, root: str, scratch: str) -> None:
    """Alerts of the machines in ``changed`` (machine_id, _first), derived again from ``_first`` on; ``since``: the date of the least of these."""
    alerts = alert_table(spark, root)
    recent = F.col("date") >= F.lit(since)
    windows = status_table(spark, root).read(recent).join(changed, "machine_id").filter(F.col("window_end") >= F.col("_first"))
    # open ones, and those resolved at or after the change: no others can be touched
    before = alerts.read(F.col("open") | recent).join(changed, "machine_id")
    before = before.filter(F.col("resolved_at").isNull() | (F.col("resolved_at") >= F.col("_first")))
    before.write.parquet(f"{scratch}/before")
    before = spark.read.schema(before.schema).parquet(f"{scratch}/before")
    after = alert_changes(windows, before.filter(F.col("triggered_at") < F.col("_first")))
    is_open = F.col("resolved_at").isNull()
    after = after.select(*ALERT.fieldNames(), "resolved_at", is_open.alias("open"), F.to_date(F.coalesce("resolved_at", "triggered_at")).alias("date"))
    before = before.select(*ALERT_TABLE.fieldNames())
    # rows that are on both sides stay as they are
    both = after.withColumn("_side", F.lit(1)).unionByName(before.withColumn("_side", F.lit(-1)))
    moved = both.groupBy(*ALERT_TABLE.fieldNames()).agg(F.sum("_side").alias("_side")).filter("_side <> 0")
    moved.write.parquet(f"{scratch}/moved")
    moved = spark.read.schema(moved.schema).parquet(f"{scratch}/moved")
    added, gone = moved.filter("_side > 0"), moved.filter("_side < 0")
    if moved.limit(1).count():
        place = ["machine_id", "triggered_at", "open", "date"]
        alerts.append(added, gone.join(added.select(*place), place, "left_anti"))


def read_status(spark: SparkSession, root: str) -> DataFrame:
    return status_table(spark, root).read().select(*STATUS.fieldNames())


def read_alerts(spark: SparkSession, root: str) -> DataFrame:
    return alert_table(spark, root).read().select(*ALERT.fieldNames())


def read_open_alerts(spark: SparkSession, root: str) -> DataFrame:
    """Unresolved alerts, from their own folders: resolved history isn't scanned."""
    return alert_table(spark, root).read(F.col("open")).select(*ALERT.fieldNames())
