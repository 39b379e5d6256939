import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rotorwatch.config import build_session  # noqa: E402
from rotorwatch.schemas import READING  # noqa: E402

SF = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("ROTORWATCH_SCRATCH", tempfile.mkdtemp(prefix="rotorwatch-tests-"))
    s = build_session("rotorwatch-tests", cores=4, shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from rotorwatch.config import scratch_path
    return scratch_path(spark, "test")


def ts(text: str) -> dt.datetime:
    """UTC timestamp from 'YYYY-MM-DD HH:MM:SS[.ffffff]'."""
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def readings(spark, rows):
    """rows: (machine_id, event_time text|None, temperature, vibration, rpm, status, event_id)."""
    from pyspark.sql import types as T
    schema = T.StructType(READING.fields + [T.StructField("event_id", T.LongType())])
    data = [(m, ts(t) if t else None, temp, vib, rpm, st, eid) for m, t, temp, vib, rpm, st, eid in rows]
    return spark.createDataFrame(data, schema)


def naive(v):
    """Spark returns session-zone (UTC) wall clock as naive datetimes."""
    return v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v
