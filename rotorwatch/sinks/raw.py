"""Raw zone sink (K1) and quarantine sink (K5)."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotorwatch.config import DEFAULT, Settings
from rotorwatch.schemas import RAW_FILE


def raw_rows(readings: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows the raw zone accepts: timed and with a machine; adds the UTC date.
    Readings with missing measurements pass through (validation is later)."""
    cols = [c for c in RAW_FILE.fieldNames() if c in readings.columns]
    return (readings
            .filter(F.col("event_time").isNotNull() & F.col("machine_id").isNotNull())
            .select(*cols, F.to_date("event_time").alias("date"), *keep))


BATCH = "batch"  # the leaf folder of a landing


def write_raw(readings: DataFrame, path: str, cfg: Settings = DEFAULT, batch: str | None = None) -> None:
    """Land readings under ``date=/machine_id=/batch=`` directories (partition
    columns from settings, then the landing's own folder).

    A landing under a ``batch`` name that was used before replaces what that
    landing wrote, and nothing else; without a name it gets one of its own.
    """
    _write(raw_rows(readings), path, cfg, batch or uuid.uuid4().hex)


def _write(rows: DataFrame, path: str, cfg: Settings, batch: str) -> None:
    """The ``rebalance`` hint lets AQE cluster rows by partition directory while
    splitting an oversized (hot) partition over several tasks, so files are
    neither tiny nor one giant file from one task.  Dynamic partition overwrite
    touches the leaf folders of this batch only.
    """
    rows = rows.hint("rebalance", *cfg.raw_partitions).withColumn(BATCH, F.lit(batch))
    if "machine_id" not in cfg.raw_partitions:
        # many machines: folders by date only (not machines x days folders);
        # rows sorted by machine inside each file, so Parquet row-group
        # statistics still let a machine filter skip the other machines
        # (folder columns first: that is the order the file writer needs, so it
        # adds no sort of its own that would undo the machine order)
        rows = rows.sortWithinPartitions(*cfg.raw_partitions, "machine_id", "event_time")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cfg.raw_partitions, BATCH).parquet(path)


def land_batch(rows: DataFrame, path: str, batch_id: int, checkpoint: str, cfg: Settings = DEFAULT) -> None:
    """Land a stream's micro-batch in the raw zone exactly once: its folders are
    named by the stream's checkpoint and the batch, so a batch that is repeated,
    whether it had ended or not, replaces itself.  No file is moved or renamed
    by this code.
    """
    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]
    _write(rows, path, cfg, f"{stream}-{batch_id}")


def write_quarantine(rows: DataFrame, path: str, run: int | str = 0, source_file: str | None = None) -> None:
    """Quarantined rows of a run, partitioned by UTC date, carrying the source
    file, in the run's own folder: a repeated run replaces its rows.

    Rows without a time go to the ``date=__HIVE_DEFAULT_PARTITION__`` folder.
    """
    out = rows.withColumn("date", F.to_date("event_time"))
    if "source_file" not in out.columns:
        out = out.withColumn("source_file", F.lit(source_file).cast("string"))
    out.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").parquet(f"{path}/run={run}")
