"""Engine settings and session helpers.

Every behaviour-defining constant lives in :class:`Settings` so a job can be
re-run with other thresholds without code changes.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Fixed values that must equal the reference's behaviour.
WINDOW_DURATION = "5 minutes"
LATE_TOLERANCE = "5 seconds"
WINDOW_VIBRATION_LIMIT = 2.0  # window ALERT when max_vibration > 2.0
WINDOW_TEMP_LIMIT = 95.0  # ... or max_temp > 95
READING_TEMP_LIMIT = 90.0  # daily anomaly when temperature > 90
READING_VIBRATION_LIMIT = 1.8  # ... or vibration > 1.8
REQUIRED_FIELDS = ("machine_id", "event_time", "temperature", "vibration", "rpm", "status")
CONTENT_TYPE = "application/json"


def duration(text: str) -> dt.timedelta:
    """A duration with its unit, as Spark's intervals take it: ``5 seconds``, ``1 minute 30 seconds``."""
    parts = text.lower().split()
    if not parts or len(parts) % 2:
        raise ValueError(f"duration {text!r} must be pairs of a number and a unit")
    units = {parts[k + 1].rstrip("s") + "s": float(parts[k]) for k in range(0, len(parts), 2)}
    if set(units) - {"microseconds", "milliseconds", "seconds", "minutes", "hours", "days", "weeks"}:
        raise ValueError(f"duration {text!r}: unknown unit")
    return dt.timedelta(**units)


@dataclass(frozen=True)
class Settings:
    """Parameters of the telemetry engine (defaults = reference behaviour)."""

    window: str = WINDOW_DURATION
    tolerance: str = LATE_TOLERANCE
    window_vib_limit: float = WINDOW_VIBRATION_LIMIT
    window_temp_limit: float = WINDOW_TEMP_LIMIT
    reading_temp_limit: float = READING_TEMP_LIMIT
    reading_vib_limit: float = READING_VIBRATION_LIMIT
    required: tuple[str, ...] = REQUIRED_FIELDS
    raw_partitions: tuple[str, ...] = ("date", "machine_id")
    time_source: str = "device"  # "device" (body.timestamp) or "enqueued"
    # late readings: "drop" (watermark) or "adjust" (device time that lags its
    # arrival by more than the tolerance is moved up to arrival - tolerance)
    late_policy: str = "drop"
    # a stream takes no reading whose time is further ahead of its arrival:
    # one device clock must not close every machine's windows
    max_ahead: str = "5 minutes"
    # a message delivered twice counts once in a stream's windows, as long as
    # its window is open
    stream_dedup: bool = True
    gated: bool = True  # daily metrics skip rows that fail validation
    tie_breaker: tuple[str, ...] = ("event_id",)
    # documented-only detectors
    roc_limit: float = 1.0
    zscore_window: int = 30
    zscore_k: float = 3.0
    # per-key sequence work is split into slices of at most this many
    # consecutive readings, so a busy machine never lands in a single task
    sequence_bucket_rows: int = 10_000


DEFAULT = Settings()

# Runtime SQL settings the engine depends on.  Time zone must be UTC: dates,
# minute buckets and window edges are defined in UTC.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the engine relies on to an existing session."""
    for key, value in SESSION_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "rotorwatch", cores: int | str = "*", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        # small local inputs: AQE may keep shuffle partitions down to 128 KB
        # (default 1 MB), so CPU-heavy window stages over a few MB still run
        # on every core instead of one task; at scale the advisory size rules
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
    )
    for key, value in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for written tables and checkpoints.

    On a cluster this is ``spark.checkpoint.dir``, or the checkpoint folder
    set at run time (a shared file system either way).  Only a local master
    may go without: it then gets a local folder (tests).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, the server brings its settings
        sc = None
    if sc is None:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        return root.rstrip("/")
    root = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(_LOCAL_KEY, None) or _set_at_run_time(sc)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError(f"master {sc.master}: spark.checkpoint.dir must name a folder that driver and executors share")
        root = os.environ.get("ROTORWATCH_SCRATCH") or os.path.join("/tmp", "rotorwatch-" + uuid.uuid4().hex[:8])
        os.makedirs(root, exist_ok=True)
        spark.conf.set(_LOCAL_KEY, root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def _set_at_run_time(sc) -> str | None:
    """The folder handed to ``setCheckpointDir``: Spark adds a folder of its own to it."""
    path = sc.getCheckpointDir()
    return path.rstrip("/").rpartition("/")[0] if path else None


_LOCAL_KEY = "rotorwatch.local.shared.dir"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared folder for one job run."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Free a scratch table once nothing reads it any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)
