"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each runs an engine operator over the whole telemetry view derived from the
driver's tables; names and output columns match ``plans/oracle.py``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rotorwatch.config import Settings, scratch_path
from rotorwatch.operators import alerts, detect, ingest, quality, reliability, reports, windows
from rotorwatch.plans import hot_path, nightly
from rotorwatch.plans.edge import zone_free
from rotorwatch.schemas import GOLD, QUARANTINE, RUN_LOG, THRESHOLD
from rotorwatch.sinks.raw import write_raw
from rotorwatch.sinks.tables import upsert
from rotorwatch.sources.raw import read_raw, read_table
from rotorwatch.sources.telemetry_view import (envelopes_from_columns, events, telemetry_columns,
                                                 telemetry_envelopes, telemetry_readings)
from rotorwatch.streaming import jobs as streaming

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed evaluation time of the closed-window query.
AS_OF = dt.datetime(2024, 1, 2, 12, 0, 5, tzinfo=dt.timezone.utc)


def register(name: str):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return wrap


@register("window_status")
def q_window_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_free(windows.window_status(telemetry_readings(spark, sf_dir)))


@register("window_status_closed")
def q_window_status_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_free(windows.closed_windows(telemetry_readings(spark, sf_dir), AS_OF))


# ---------------------------------------------------------------- ingest

def _lines(spark: SparkSession, sf_dir: str, cut_every: int | None = None) -> DataFrame:
    """Envelope JSON lines (``value``) with event_id as the message offset.
    With ``cut_every``, the line of every matching event loses its last 9
    characters, like a half-written line."""
    env = telemetry_envelopes(events(spark, sf_dir))
    lines = ingest.encode_envelopes(env, keep=("event_id",))
    if cut_every:
        cut = F.col("event_id") % cut_every == 3
        lines = lines.withColumn("value", F.when(cut, F.expr("substring(value, 1, length(value) - 9)"))
                                 .otherwise(F.col("value")))
    return lines


@register("telemetry_parse")
def q_telemetry_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = telemetry_envelopes(events(spark, sf_dir))
    return zone_free(ingest.envelope_to_reading(env, keep=("event_id",)))


@register("telemetry_parse_enqueued")
def q_telemetry_parse_enqueued(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = telemetry_envelopes(events(spark, sf_dir))
    return zone_free(ingest.envelope_to_reading(env, Settings(time_source="enqueued"), keep=("event_id",)))


@register("envelope_roundtrip")
def q_envelope_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings, _ = ingest.parse_envelopes(_lines(spark, sf_dir), keep=("event_id",))
    return zone_free(readings)


@register("malformed_lines")
def q_malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings, corrupt = ingest.parse_envelopes(_lines(spark, sf_dir, cut_every=401), keep=("event_id",))
    return (readings.select("event_id", F.lit(False).alias("corrupt"))
            .unionByName(corrupt.select("event_id", F.lit(True).alias("corrupt"))))


def device_registry(readings: DataFrame) -> DataFrame:
    """Devices seen in the data; every sixth machine number is not registered."""
    number = F.regexp_extract("machine_id", r"(\d+)$", 1).cast("int")
    return (readings.filter(F.col("machine_id").isNotNull()).select("machine_id").distinct()
            .select(F.col("machine_id").alias("device_id"), (number % 6 != 0).alias("registered")))


@register("registered_devices")
def q_registered_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = telemetry_readings(spark, sf_dir)
    return zone_free(ingest.split_registered(r, device_registry(r))[0])


@register("unregistered_devices")
def q_unregistered_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = telemetry_readings(spark, sf_dir)
    return zone_free(ingest.split_registered(r, device_registry(r))[1])


# ---------------------------------------------------------------- raw zone

@register("raw_rows_by_partition")
def q_raw_rows_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    write_raw(telemetry_readings(spark, sf_dir), path)
    return reports.partition_counts(read_raw(spark, path))


@register("validation_by_partition")
def q_validation_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per raw-zone partition (UTC date, machine): rows, failing rows and
    required columns without any value (D8), read back from the written zone."""
    path = scratch_path(spark, "raw")
    write_raw(telemetry_readings(spark, sf_dir), path)
    return quality.validation_report(read_raw(spark, path), ["date", "machine_id"])


# ---------------------------------------------------------------- alerts and reads

def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_status(telemetry_readings(spark, sf_dir))


@register("alert_lifecycle")
def q_alert_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_free(alerts.alert_lifecycle(_status(spark, sf_dir)).drop("alert_id"))


@register("unresolved_alerts")
def q_unresolved_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.unresolved_count(alerts.alert_lifecycle(_status(spark, sf_dir)))


@register("alert_feed")
def q_alert_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "hot")
    hot_path.write_batch(spark, _status(spark, sf_dir), root)
    return zone_free(reports.alert_feed(hot_path.read_alerts(spark, root)).drop("alert_id"))


@register("alert_lifecycle_incremental")
def q_alert_lifecycle_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows in three batches by time, the last one given twice: the alerts of the whole history."""
    root = scratch_path(spark, "hot")
    status = _status(spark, sf_dir)
    cuts = [dt.datetime(2024, 1, 1, 8, tzinfo=dt.timezone.utc), dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc)]
    end = F.col("window_end")
    parts = [end <= F.lit(cuts[0]), (end > F.lit(cuts[0])) & (end <= F.lit(cuts[1])), end > F.lit(cuts[1])]
    for part in (*parts, parts[-1]):
        hot_path.write_batch(spark, status.filter(part), root)
    return zone_free(hot_path.read_alerts(spark, root).drop("alert_id"))


@register("alert_lifecycle_shuffled")
def q_alert_lifecycle_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows in three batches out of order, the first with every health status wrong, then corrected: the alerts of
    the whole history."""
    root = scratch_path(spark, "hot")
    status = _status(spark, sf_dir)
    part = F.pmod(F.xxhash64("machine_id", "window_end"), F.lit(3))
    wrong = F.when(F.col("health_status") == "OK", "ALERT").otherwise("OK")
    hot_path.write_batch(spark, status.filter(part == 0).withColumn("health_status", wrong), root)
    for k in (2, 1, 0):
        hot_path.write_batch(spark, status.filter(part == k), root)
    return zone_free(hot_path.read_alerts(spark, root).drop("alert_id"))


@register("open_alerts")
def q_open_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts that are open after two batches, the later half of the windows first, from the folders of open alerts."""
    root = scratch_path(spark, "hot")
    status = _status(spark, sf_dir)
    late = F.col("window_end") > F.lit(dt.datetime(2024, 1, 2, tzinfo=dt.timezone.utc))
    for part in (late, ~late):
        hot_path.write_batch(spark, status.filter(part), root)
    hot_path.status_table(spark, root).compact()
    hot_path.alert_table(spark, root).compact()
    return zone_free(hot_path.read_open_alerts(spark, root).drop("alert_id", "resolved"))


@register("raw_mixed_writers")
def q_raw_mixed_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw zone, landed by a stream (odd events) and by a batch (even ones): rows per partition."""
    root = scratch_path(spark, "mixed")
    lines = _lines(spark, sf_dir)
    lines.filter("event_id % 2 = 1").select("value").write.text(f"{root}/landing")
    for q in streaming.start_raw_sink(streaming.message_stream(spark, f"{root}/landing"), f"{root}/raw", f"{root}/corrupt", f"{root}/ckpt"):
        q.awaitTermination()
    write_raw(telemetry_readings(spark, sf_dir).filter("event_id % 2 = 0"), f"{root}/raw")
    return reports.partition_counts(read_raw(spark, f"{root}/raw"))


@register("status_feed")
def q_status_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "hot")
    hot_path.write_batch(spark, _status(spark, sf_dir), root)
    return zone_free(reports.status_feed(hot_path.read_status(spark, root)))


@register("latest_status")
def q_latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_free(reports.latest_status(_status(spark, sf_dir)))


@register("status_grid")
def q_status_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.status_grid(_status(spark, sf_dir))


# ---------------------------------------------------------------- quality and reliability

@register("validation_summary")
def q_validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.validation_summary(telemetry_readings(spark, sf_dir))


@register("valid_rows")
def q_valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_free(quality.split_valid(telemetry_readings(spark, sf_dir))[0])


@register("quarantine_rows")
def q_quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_free(quality.split_valid(telemetry_readings(spark, sf_dir))[1])


@register("dedup_latest_per_minute")
def q_dedup_latest_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_free(reliability.dedup_latest(telemetry_readings(spark, sf_dir)))


@register("daily_reliability")
def q_daily_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_free(reliability.daily_reliability(telemetry_readings(spark, sf_dir), gated=False))


@register("daily_reliability_gated")
def q_daily_reliability_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_free(reliability.daily_reliability(telemetry_readings(spark, sf_dir), gated=True))


# Fixed backfill day of the upsert query.
BACKFILL_DAY = dt.date(2024, 1, 2)


@register("gold_upsert")
def q_gold_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold from the ungated job, then the gated backfill of one day, run twice."""
    raw = scratch_path(spark, "raw")
    gold = scratch_path(spark, "gold")
    write_raw(telemetry_readings(spark, sf_dir), raw)
    upsert(spark, gold, reliability.daily_reliability(read_raw(spark, raw), gated=False),
           ["machine_id", "date"], "date", GOLD)
    for _ in range(2):
        nightly.backfill(spark, raw, gold, BACKFILL_DAY, BACKFILL_DAY, Settings(gated=True))
    return zone_free(read_table(spark, gold, GOLD))


@register("uptime_trend_pivot")
def q_uptime_trend_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = reliability.daily_reliability(telemetry_readings(spark, sf_dir), gated=True)
    return reports.uptime_pivot(gold)


@register("uptime_trend")
def q_uptime_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.uptime_trend(reliability.daily_reliability(telemetry_readings(spark, sf_dir), gated=True))


@register("gold_display")
def q_gold_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_free(reports.gold_display(reliability.daily_reliability(telemetry_readings(spark, sf_dir), gated=True)))


# ---------------------------------------------------------------- documented-only detectors

@register("rate_of_change")
def q_rate_of_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_free(detect.rate_of_change(telemetry_readings(spark, sf_dir)))


@register("zscore_anomaly")
def q_zscore_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_free(detect.zscore_anomaly(telemetry_readings(spark, sf_dir)))


# Fixed values of the machine-type example (ours: the reference names the idea only).
MACHINE_TYPES = {1: "press", 2: "lathe", 0: "pump"}  # by machine number % 3
TYPE_LIMITS = [("press", 2.0, 95.0), ("lathe", 1.5, 85.0)]  # pump has none -> default


def machine_types(readings: DataFrame) -> DataFrame:
    """machine_id -> machine_type for every machine in the data."""
    number = F.regexp_extract("machine_id", r"(\d+)$", 1).cast("int")
    kind = F.when(number % 3 == 1, MACHINE_TYPES[1]).when(number % 3 == 2, MACHINE_TYPES[2]) \
        .otherwise(MACHINE_TYPES[0])
    return (readings.filter(F.col("machine_id").isNotNull()).select("machine_id").distinct()
            .select("machine_id", kind.alias("machine_type")))


@register("typed_thresholds")
def q_typed_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = telemetry_readings(spark, sf_dir)
    limits = spark.createDataFrame(TYPE_LIMITS, THRESHOLD)
    out = detect.apply_thresholds(readings, machine_types(readings), limits,
                                  Settings().reading_vib_limit, Settings().reading_temp_limit)
    return zone_free(out)


# ---------------------------------------------------------------- streaming (stream = batch)

def _stream_runs(spark: SparkSession, sf_dir: str, sinks: tuple[str, ...]) -> str:
    """Replay the message lines as a stream: one landing per UTC date of the
    readings, in time order (lines without a time land first); after each
    landing the queries drain what is there and stop (availableNow), and the
    next landing resumes them from their checkpoints."""
    t = telemetry_columns(events(spark, sf_dir)).withColumn("_day", F.to_date("event_time"))
    lines = ingest.encode_envelopes(envelopes_from_columns(t, "_day"), keep=("event_id", "_day"))
    # bounded list: the UTC dates of the data
    days = sorted(r[0] for r in t.select("_day").distinct().collect() if r[0] is not None)
    root = scratch_path(spark, "stream")
    for i, d in enumerate(days):
        landing = (F.col("_day") == d) | (F.col("_day").isNull() if i == 0 else F.lit(False))
        lines.filter(landing).select("value").write.mode("append").text(f"{root}/landing")
        started = []
        if "raw" in sinks:
            started += streaming.start_raw_sink(streaming.message_stream(spark, f"{root}/landing"),
                                                f"{root}/raw", f"{root}/corrupt", f"{root}/ckpt")
        if "hot" in sinks:
            started.append(streaming.start_hot_path(streaming.message_stream(spark, f"{root}/landing"),
                                                    f"{root}/hot", f"{root}/ckpt"))
        for q in started:
            q.awaitTermination()
    return root


@register("stream_window_status")
def q_stream_window_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stream_runs(spark, sf_dir, ("hot",))
    return zone_free(hot_path.read_status(spark, f"{root}/hot"))


@register("stream_window_status_complete")
def q_stream_window_status_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream with every tenth message delivered twice, stopped and resumed between the two deliveries, that then falls
    quiet: a clock closes the last windows, so all windows of the clean batch are there."""
    root = scratch_path(spark, "stream")
    lines = _lines(spark, sf_dir)
    end = telemetry_readings(spark, sf_dir).agg(F.max("event_time").alias("last"))

    def drain() -> None:
        messages, clock = streaming.message_stream(spark, f"{root}/landing"), streaming.clock_stream(spark, f"{root}/clock")
        streaming.start_hot_path(messages, f"{root}/hot", f"{root}/ckpt", clock=clock).awaitTermination()

    def beat(after: str) -> None:
        end.select(F.date_format(F.col("last") + F.expr(f"INTERVAL {after}"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("value")) \
            .write.mode("append").text(f"{root}/clock")

    beat("-40 DAYS")
    lines.select("value").write.text(f"{root}/landing")
    drain()
    lines.filter("event_id % 10 = 0").select("value").write.mode("append").text(f"{root}/landing")
    drain()
    beat("10 MINUTES")
    drain()
    return zone_free(hot_path.read_status(spark, f"{root}/hot"))


@register("stream_alert_lifecycle")
def q_stream_alert_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stream_runs(spark, sf_dir, ("hot",))
    return zone_free(hot_path.read_alerts(spark, f"{root}/hot").drop("alert_id"))


@register("stream_raw_rows_by_partition")
def q_stream_raw_rows_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stream_runs(spark, sf_dir, ("raw",))
    return reports.partition_counts(read_raw(spark, f"{root}/raw"))


# ---------------------------------------------------------------- nightly run

def _nightly_twice(spark: SparkSession, sf_dir: str) -> str:
    """Land raw, run the nightly job (new files: all), run it again (none new)."""
    root = scratch_path(spark, "nightly")
    write_raw(telemetry_readings(spark, sf_dir), f"{root}/raw")
    for _ in range(2):
        nightly.run_nightly(spark, f"{root}/raw", f"{root}/gold", f"{root}/quarantine", f"{root}/runs")
    return root


@register("nightly_counts")
def q_nightly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deterministic part of the run log: status and row counts per run."""
    runs = read_table(spark, f"{_nightly_twice(spark, sf_dir)}/runs", RUN_LOG)
    return runs.select("status", "rows_validated", "rows_quarantined")


@register("nightly_clean")
def q_nightly_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold after a nightly run over a raw zone without a single bad row."""
    root = scratch_path(spark, "nightly")
    write_raw(quality.split_valid(telemetry_readings(spark, sf_dir))[0], f"{root}/raw")
    nightly.run_nightly(spark, f"{root}/raw", f"{root}/gold", f"{root}/quarantine", f"{root}/runs")
    return zone_free(read_table(spark, f"{root}/gold", GOLD))


@register("nightly_missing_columns")
def q_nightly_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the nightly run reports about files that lack columns: those of one landing have no rpm."""
    root = scratch_path(spark, "nightly")
    readings = telemetry_readings(spark, sf_dir)
    write_raw(readings.filter("event_id % 3 = 0").drop("rpm"), f"{root}/raw")
    write_raw(readings.filter("event_id % 3 <> 0"), f"{root}/raw")
    nightly.run_nightly(spark, f"{root}/raw", f"{root}/gold", f"{root}/quarantine", f"{root}/runs")
    report = spark.read.parquet(nightly.report_path(f"{root}/quarantine"))
    return report.filter("missing_columns LIKE '%rpm%'").agg(F.sum("rows").alias("rows"), F.sum("rows_quarantined").alias("rows_quarantined"))


@register("nightly_quarantine")
def q_nightly_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined rows landed by the nightly run, per UTC date."""
    q = read_table(spark, f"{_nightly_twice(spark, sf_dir)}/quarantine", QUARANTINE)
    return q.groupBy("date").agg(F.count(F.lit(1)).alias("rows"))


@register("window_status_adjusted")
def q_window_status_adjusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status windows under the "adjust" late policy, parsed from the message lines."""
    cfg = Settings(late_policy="adjust")
    readings, _ = ingest.parse_envelopes(_lines(spark, sf_dir), cfg)
    return zone_free(windows.window_status(readings, cfg))
