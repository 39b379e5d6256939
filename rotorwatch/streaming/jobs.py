"""Structured Streaming jobs.

One message source feeds independent queries, each with its own checkpoint
(fan-out): the raw-zone sink, the corrupt-line sink, the hot path, and the
readings that are ahead of their time.  The raw zone and the hot path write
through ``foreachBatch`` with the batch writers, keyed or by batch, so a
replayed micro-batch changes nothing; the others use the exactly-once file sink.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rotorwatch.config import DEFAULT, Settings, prepare, shared_dir
from rotorwatch.functions import safe_timestamp
from rotorwatch.operators.ingest import parse_envelopes, with_registration
from rotorwatch.operators.windows import WINDOW_TIME, window_parts, windows_of_parts, with_window, with_window_time
from rotorwatch.plans.hot_path import write_batch
from rotorwatch.sinks.raw import raw_rows, land_batch


def message_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Message lines landing as text files under ``path`` (one JSON envelope per
    line).  A Kafka source has the same ``value`` column after a cast."""
    prepare(spark)
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def _trigger(writer, trigger: str | None):
    """``None`` or "available_now": drain what is there and stop (``--once``);
    "N seconds": poll every N seconds (``--watch --poll N``)."""
    if trigger in (None, "available_now"):
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def start_raw_sink(lines: DataFrame, raw_path: str, corrupt_path: str, checkpoint: str,
                   cfg: Settings = DEFAULT, trigger: str | None = None, registry: str | None = None,
                   rejected_path: str | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """Parse messages; land timed readings in the partitioned raw zone and
    undecodable lines in the corrupt-line folder.  Readings with missing
    measurements pass through to raw (validation happens in the batch run).

    The raw zone is written by the batch writer, so a stream and batches share
    one zone, files are rebalanced, and a repeated micro-batch adds nothing
    (``sinks.raw.land_batch``).  ``event_id`` is a hash of the
    message: a total order for ties that does not depend on how files are split.

    ``registry``: a folder with a table of devices (``ingest.with_registration``).
    Readings of devices not registered when they arrived then land in
    ``rejected_path``, laid out like the raw zone, and not in the raw zone.  The
    registry is read anew for every micro-batch, so a device registered while the
    stream runs is taken from then on; what arrived earlier stays rejected, also
    when a batch is repeated later.  Without an arrival time the micro-batch's
    own time, which its repetition keeps, decides.
    """
    if (registry is None) != (rejected_path is None):
        raise ValueError("registry and rejected_path go together")
    keyed = lines.withColumn("event_id", F.xxhash64("value"))
    readings, corrupt = parse_envelopes(keyed, cfg, keep=("event_id",), arrival=registry is not None)
    if registry is None:
        rows = raw_rows(readings)
    else:
        rows = raw_rows(readings.withColumn("arrived_at", F.coalesce("arrived_at", F.current_timestamp())), keep=("arrived_at",))

    def land(batch: DataFrame, batch_id: int) -> None:
        if registry is None:
            land_batch(batch, raw_path, batch_id, f"{checkpoint}/raw", cfg)
            return
        batch = batch.persist()
        try:
            marked = with_registration(batch, batch.sparkSession.read.parquet(registry))
            for taken, path in ((True, raw_path), (False, rejected_path)):
                land_batch(marked.filter(F.col("registered") == taken).drop("registered", "arrived_at"), path, batch_id, f"{checkpoint}/raw", cfg)
        finally:
            batch.unpersist()

    raw_q = _trigger(rows.writeStream.foreachBatch(land)
                     .option("checkpointLocation", f"{checkpoint}/raw")
                     .outputMode("append"), trigger).start()
    bad_q = _trigger(corrupt.select("value").writeStream.format("parquet")
                     .option("path", corrupt_path)
                     .option("checkpointLocation", f"{checkpoint}/corrupt")
                     .outputMode("append"), trigger).start()
    return raw_q, bad_q


def in_time(readings: DataFrame, cfg: Settings = DEFAULT) -> Column:
    """Whether a reading's time is no further ahead of its arrival than
    ``max_ahead``; without an arrival time the clock of the run decides."""
    arrival = F.coalesce("arrived_at", F.current_timestamp())
    return F.col("event_time").isNull() | (F.col("event_time") <= arrival + F.expr(f"INTERVAL {cfg.max_ahead}"))


def clock_stream(spark: SparkSession, path: str) -> DataFrame:
    """Clock times, ISO text, one per line of the files landing under ``path``,
    as ``beat``: whoever feeds the stream says up to when it is complete."""
    return message_stream(spark, path).select(safe_timestamp("value").alias("beat"))


def wall_clock(spark: SparkSession, seconds: int = 5) -> DataFrame:
    """This cluster's clock as ``beat``, for streams whose devices keep its time."""
    prepare(spark)
    rate = spark.readStream.format("rate").option("rowsPerSecond", "1").load()
    return rate.filter(F.col("value") % seconds == 0).select(F.col("timestamp").alias("beat"))


def status_stream(lines: DataFrame, cfg: Settings = DEFAULT, clock: DataFrame | None = None) -> DataFrame:
    """Parts of closed five-minute windows per machine; all parts of a window
    come in one micro-batch, where ``windows_of_parts`` joins them.  The watermark sits on the
    shifted time ``_wt``; a window is emitted once, ``tolerance`` after its end
    has been passed by the newest event time, and later readings for it are
    dropped (counted in ``numRowsDroppedByWatermark``).  Readings ahead of
    their arrival go to :func:`start_ahead_sink` instead and never move the
    watermark.

    ``clock`` (a stream of ``beat`` times) moves the watermark as readings do,
    so a stream that falls quiet closes its last windows too: each is emitted
    once a beat is ``tolerance`` past its end.  With ``stream_dedup`` a message
    that is delivered again while its window is open is dropped; what is
    remembered of messages goes with their window.
    """
    keyed = lines.withColumn("_message", F.xxhash64("value"))
    readings, _ = parse_envelopes(keyed, cfg, keep=("_message",), arrival=True)
    timed = with_window_time(readings.filter(in_time(readings, cfg)))
    if clock is not None:
        timed = timed.unionByName(clock.filter("beat IS NOT NULL").select(F.col("beat").alias(WINDOW_TIME)), allowMissingColumns=True)
    timed = timed.withWatermark(WINDOW_TIME, cfg.tolerance)
    if clock is not None:
        # beats have done their work; one predicate that names the time column is not pushed below the watermark
        timed = timed.filter(F.col("machine_id").isNotNull() | F.col(WINDOW_TIME).isNull())
    timed = with_window(timed, cfg)
    if cfg.stream_dedup:
        timed = timed.dropDuplicates(["w", "_message"])
    return window_parts(timed, cfg)


def start_ahead_sink(lines: DataFrame, path: str, checkpoint: str, cfg: Settings = DEFAULT,
                     trigger: str | None = None) -> StreamingQuery:
    """Readings whose time is too far ahead of their arrival, for a device's
    owner to see; the raw zone holds them as well."""
    readings, _ = parse_envelopes(lines, cfg, arrival=True)
    return _trigger(readings.filter(~in_time(readings, cfg)).writeStream.format("parquet")
                    .option("path", path)
                    .option("checkpointLocation", f"{checkpoint}/ahead")
                    .outputMode("append"), trigger).start()


def start_hot_path(lines: DataFrame, root: str, checkpoint: str, cfg: Settings = DEFAULT,
                   trigger: str | None = None, clock: DataFrame | None = None) -> StreamingQuery:
    """machine_status and active_alerts under ``root``.  The stream's state is
    its open windows; alerts follow from the windows of each micro-batch and
    the alert table, in the step that batches take (``hot_path.write_batch``).
    ``clock``: see :func:`status_stream`."""
    shared_dir(lines.sparkSession)
    writer = (status_stream(lines, cfg, clock).writeStream
              .foreachBatch(lambda batch, _: write_batch(batch.sparkSession, windows_of_parts(batch, cfg), root))
              .option("checkpointLocation", f"{checkpoint}/hot_path")
              .outputMode("append"))
    return _trigger(writer, trigger).start()
