"""Nightly reliability run and backfill (orchestration of S5, P5, K5, W1, A2, K6, K7, R4).

Steps of one run: take the raw files that no run has taken yet; count and
quarantine incomplete rows, and report columns that files lack; recompute
daily metrics for the dates those files touch (partition-pruned); upsert them
into gold; log the run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rotorwatch.config import DEFAULT, Settings, shared_dir
from rotorwatch.operators.quality import conform, is_incomplete, validation_report
from rotorwatch.operators.reliability import daily_reliability
from rotorwatch.schemas import GOLD
from rotorwatch.sinks.raw import write_quarantine
from rotorwatch.sinks.tables import append_run, upsert
from rotorwatch.sources.raw import new_raw_files, read_raw


def day_range(start: dt.date, end: dt.date) -> list[dt.date]:
    return [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]


def backfill(spark: SparkSession, raw_path: str, gold_path: str, start: dt.date, end: dt.date,
             cfg: Settings = DEFAULT) -> int:
    """Recompute gold for ``start..end`` from raw and upsert it: idempotent."""
    days = day_range(start, end)
    daily = daily_reliability(read_raw(spark, raw_path, days), cfg)
    return upsert(spark, gold_path, daily, ["machine_id", "date"], "date", GOLD)


def run_nightly(spark: SparkSession, raw_path: str, gold_path: str, quarantine_path: str, log_path: str,
                cfg: Settings = DEFAULT, started_at: dt.datetime | None = None) -> dict:
    """One orchestrated run; returns the run-log record it appended.

    New files come from a file stream that drains and stops: its checkpoint
    (under ``log_path``) lists the files taken, whatever their times, so a file
    that becomes visible late is taken by the next run.  A run that dies is
    repeated with the same files under the same number: it replaces its own
    quarantine rows and reports, and the upsert is keyed.
    """
    shared_dir(spark)
    started_at = started_at or dt.datetime.now(dt.timezone.utc)
    done = {"files": 0, "rows": 0, "bad": 0}

    def take(batch: DataFrame, number: int) -> None:
        new = conform(batch, cfg.required)
        # a bounded list: a row per date; files are counted by their first row
        stats = new.groupBy("date").agg(F.count_if(F.col("file_row") == 0).alias("files"),
                                        F.count(F.lit(1)).alias("rows"),
                                        F.count_if(is_incomplete(cfg.required)).alias("bad")).collect()
        write_quarantine(new.filter(is_incomplete(cfg.required)).drop("file_row"), quarantine_path, number)
        report = validation_report(new, ["source_file"], cfg.required).filter("missing_columns <> ''")
        report.write.mode("overwrite").parquet(f"{report_path(quarantine_path)}/run={number}")
        touched = sorted(r["date"] for r in stats if r["date"] is not None)
        if touched:
            daily = daily_reliability(read_raw(spark, raw_path, touched), cfg)
            upsert(spark, gold_path, daily, ["machine_id", "date"], "date", GOLD)
        for name in done:
            done[name] += sum(r[name] for r in stats)

    try:
        files = new_raw_files(spark, raw_path)
    except AnalysisException as e:  # nothing has been landed yet
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
    else:
        files.writeStream.foreachBatch(take).option("checkpointLocation", f"{log_path}/_files") \
            .trigger(availableNow=True).start().awaitTermination()
    if done["rows"]:
        record = {"started_at": started_at, "status": "success", "files_seen": done["files"],
                  "rows_validated": done["rows"], "rows_quarantined": done["bad"]}
    else:
        record = {"started_at": started_at, "status": "skipped_no_new_files", "files_seen": 0}
    append_run(spark, log_path, record)
    return record


def report_path(quarantine_path: str) -> str:
    """Files that lack required columns: source_file, rows, rows_quarantined, missing_columns."""
    return f"{quarantine_path.rstrip('/')}_report"
