"""Alerts under batches in any order, and tables merged on reading."""

import os
import random

import pytest
from conftest import naive, ts
from pyspark.sql import types as T

from rotorwatch.operators.alerts import alert_lifecycle
from rotorwatch.plans import hot_path
from rotorwatch.schemas import STATUS
from rotorwatch.sinks import deltas
from rotorwatch.sinks.deltas import DeltaTable


def _rows(spark, rows):
    """rows: (machine, minute of the day, health)."""
    data = [(m, ts(f"2024-01-0{1 + t // 1440} {t % 1440 // 60:02d}:{t % 60:02d}:00"), 70.0, 96.0 if h == "ALERT" else 70.0, 0.5, 0.5 + t / 1000, h) for m, t, h in rows]
    return spark.createDataFrame(data, STATUS)


def _alerts(df):
    return sorted((r["machine_id"], naive(r["triggered_at"]).isoformat(), r["resolved"], r["reason"]) for r in df.collect())


def _write(spark, root, *batches):
    for b in batches:
        hot_path.write_batch(spark, _rows(spark, b), root)
    return [(t[11:16], resolved) for _, t, resolved, _ in _alerts(hot_path.read_alerts(spark, root))]


A, O = "ALERT", "OK"  # noqa: E741


def test_a_corrected_window_takes_its_alert_back(spark, tmp_root):
    assert _write(spark, tmp_root, [("m", 600, A), ("m", 605, O)], [("m", 600, O), ("m", 605, O)]) == []
    assert hot_path.read_open_alerts(spark, tmp_root).count() == 0


def test_an_earlier_alert_takes_over(spark, tmp_root):
    assert _write(spark, tmp_root, [("m", 600, A)], [("m", 595, A)]) == [("09:55", False)]


def test_a_late_ok_splits_an_alert(spark, tmp_root):
    assert _write(spark, tmp_root, [("m", 600, A), ("m", 610, A)], [("m", 605, O)]) == [("10:00", True), ("10:10", False)]
    assert [naive(r["triggered_at"]).strftime("%H:%M") for r in hot_path.read_open_alerts(spark, tmp_root).collect()] == ["10:10"]


@pytest.mark.parametrize("seed", [1, 2])
def test_alerts_follow_from_the_status_table_after_any_batches(spark, tmp_root, seed):
    rng = random.Random(seed)
    final = {}
    for _ in range(5):
        batch = {(rng.choice("mn"), rng.choice([0, 5, 10, 15, 700, 1435, 1440, 1445, 2000])): rng.choice([A, A, O]) for _ in range(rng.randint(1, 6))}
        for _ in range(rng.choice([1, 1, 2])):  # some twice
            hot_path.write_batch(spark, _rows(spark, [(*k, h) for k, h in batch.items()]), tmp_root)
        final.update(batch)
        whole = _rows(spark, [(*k, h) for k, h in final.items()])
        assert _alerts(hot_path.read_alerts(spark, tmp_root)) == _alerts(alert_lifecycle(whole))
    assert sorted(map(tuple, hot_path.read_status(spark, tmp_root).collect())) == sorted(map(tuple, whole.collect()))


def test_an_unchanged_batch_writes_no_alerts(spark, tmp_root):
    _write(spark, tmp_root, [("m", 600, A), ("m", 605, O), ("n", 600, A)])
    version = hot_path.alert_table(spark, tmp_root).version()
    _write(spark, tmp_root, [("m", 600, A), ("m", 605, O), ("n", 600, A)])
    assert hot_path.alert_table(spark, tmp_root).version() == version


SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("p", T.StringType())])


@pytest.fixture()
def table(spark, tmp_root):
    return DeltaTable(spark, f"{tmp_root}/t", SCHEMA, ("k",), ("p",))


def _content(t):
    return sorted(map(tuple, t.read().collect()))


def test_later_batches_win_and_tombstones_delete(spark, table):
    make = lambda rows: spark.createDataFrame(rows, SCHEMA)
    assert _content(table) == []
    table.append(make([(1, "a", "x"), (2, "b", "x"), (1, "c", "y")]))
    table.append(make([(2, "B", "x"), (3, "d", "z")]), gone=make([(1, None, "x"), (9, None, "x")]))
    want = [(1, "c", "y"), (2, "B", "x"), (3, "d", "z")]
    assert _content(table) == want
    old = table.read()
    table.compact()
    assert _content(table) == want and sorted(map(tuple, old.collect())) == want
    table.append(make([(1, "again", "x")]))
    assert table.vacuum() == 2
    assert _content(table) == [(1, "again", "x"), *want]
    assert table.version()[1] == [3, 4]


def test_many_batches_are_compacted(spark, table, monkeypatch):
    monkeypatch.setattr(deltas, "COMPACT_AFTER", 3)
    for k in range(6):
        table.append(spark.createDataFrame([(k % 2, str(k), "x")], SCHEMA))
    assert len(table.version()[1]) <= 4 and _content(table) == [(0, "4", "x"), (1, "5", "x")]


@pytest.mark.parametrize("step", ["_write", "_publish"])
@pytest.mark.parametrize("work", ["append", "compact"])
def test_a_writer_that_stops_leaves_a_whole_table(spark, table, monkeypatch, step, work):
    rows = spark.createDataFrame([(1, "new", "x"), (5, "e", "x")], SCHEMA)
    for v in ("a", "b"):
        table.append(spark.createDataFrame([(1, v, "x"), (2, v, "y")], SCHEMA))
    before = _content(table)
    real = getattr(DeltaTable, step)

    def stops(self, *args):
        if step == "_write":
            real(self, *args)  # files are there, the entry isn't
        raise OSError("stopped")

    with monkeypatch.context() as m:
        m.setattr(DeltaTable, step, stops)
        with pytest.raises(OSError, match="stopped"):
            table.append(rows) if work == "append" else table.compact()
    assert _content(table) == before
    table.append(rows)  # the next writer replaces what is left over
    assert _content(table) == [(1, "new", "x"), (2, "b", "y"), (5, "e", "x")]


def test_a_batch_writes_its_own_rows_only(spark, tmp_root):
    _write(spark, tmp_root, [(f"m{k}", 600, O) for k in range(50)])
    _write(spark, tmp_root, [("m1", 605, O)])
    table = hot_path.status_table(spark, tmp_root)
    last = table.version()[1][-1]
    assert spark.read.parquet(f"{table.path}/batch={last}").count() == 1
    assert os.listdir(f"{table.path}/batch={last}/") and hot_path.read_status(spark, tmp_root).count() == 51


def test_two_writers_are_refused(spark, table):
    rows = spark.createDataFrame([(1, "a", "x")], SCHEMA)
    table.append(rows)
    with pytest.raises(RuntimeError, match="one writer"):
        table._publish(1, [1])
