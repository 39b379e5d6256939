import datetime as dt
import os

import pytest
from conftest import readings

from rotorwatch.plans.nightly import run_nightly
from rotorwatch.schemas import GOLD, RUN_LOG
from rotorwatch.sinks.raw import write_raw
from rotorwatch.sinks.tables import DuplicateKeyError, upsert
from rotorwatch.sources.raw import read_raw, read_table

D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def _gold(spark, rows):
    return spark.createDataFrame([(m, d, n, 0, 70.0, 0.5, 1.0) for m, d, n in rows], GOLD)


def _snapshot(spark, path):
    return sorted((r["machine_id"], r["date"], r["total_readings"]) for r in read_table(spark, path, GOLD).collect())


def test_upsert_replace_keep_insert_idempotent(spark, tmp_root):
    # G20, G21
    path = f"{tmp_root}/gold"
    upsert(spark, path, _gold(spark, [("m1", D1, 1), ("m2", D1, 1), ("m1", D2, 1)]), ["machine_id", "date"], "date")
    incoming = _gold(spark, [("m1", D1, 9), ("m3", D3, 9)])
    for _ in range(2):
        upsert(spark, path, incoming, ["machine_id", "date"], "date")
        assert _snapshot(spark, path) == [("m1", D1, 9), ("m1", D2, 1), ("m2", D1, 1), ("m3", D3, 9)]
    assert upsert(spark, path, _gold(spark, []), ["machine_id", "date"], "date") == 0
    assert len(_snapshot(spark, path)) == 4


def test_upsert_rejects_duplicate_keys(spark, tmp_root):
    with pytest.raises(DuplicateKeyError):
        upsert(spark, f"{tmp_root}/gold", _gold(spark, [("m1", D1, 1), ("m1", D1, 2)]), ["machine_id", "date"], "date")


def test_raw_zone_roundtrip_and_pruning(spark, tmp_root):
    r = readings(spark, [("m1", "2024-01-01 00:00:10", 70.0, 0.5, 1.0, "s", 1),
                         ("007", "2024-01-02 00:00:10", 70.0, None, 1.0, "s", 2),
                         ("m1", None, 70.0, 0.5, 1.0, "s", 3)])
    write_raw(r, f"{tmp_root}/raw")
    back = read_raw(spark, f"{tmp_root}/raw")
    assert sorted(x["event_id"] for x in back.collect()) == [1, 2]
    assert read_raw(spark, f"{tmp_root}/raw", [D2]).first()["machine_id"] == "007"  # stays a string
    plan = read_raw(spark, f"{tmp_root}/raw", [D2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_nightly_success_then_skip(spark, tmp_root):
    # G22, G23
    r = readings(spark, [("m1", "2024-01-01 00:00:10", 70.0, 0.5, None, "s", 1),
                         ("m1", "2024-01-01 00:01:10", 70.0, 0.5, 1.0, "s", 2)])
    write_raw(r, f"{tmp_root}/raw")
    args = (spark, f"{tmp_root}/raw", f"{tmp_root}/gold", f"{tmp_root}/q", f"{tmp_root}/runs")
    first = run_nightly(*args)
    assert (first["status"], first["rows_validated"], first["rows_quarantined"]) == ("success", 2, 1)
    files = [f for _, _, fs in os.walk(f"{tmp_root}/raw") for f in fs if f.endswith(".parquet")]
    assert first["files_seen"] == len(files) >= 1
    second = run_nightly(*args)
    assert second == {"started_at": second["started_at"], "status": "skipped_no_new_files", "files_seen": 0}
    log = read_table(spark, f"{tmp_root}/runs", RUN_LOG).orderBy("started_at").collect()
    assert [x["status"] for x in log] == ["success", "skipped_no_new_files"]
    assert read_table(spark, f"{tmp_root}/gold", GOLD).first()["total_readings"] == 1


def _nightly(spark, root):
    return run_nightly(spark, f"{root}/raw", f"{root}/gold", f"{root}/q", f"{root}/runs")


def test_nightly_on_clean_input(spark, tmp_root):
    assert _nightly(spark, tmp_root)["status"] == "skipped_no_new_files"  # nothing landed yet
    write_raw(readings(spark, [("m1", "2024-01-01 00:00:10", 70.0, 0.5, 1.0, "s", 1)]), f"{tmp_root}/raw")
    record = _nightly(spark, tmp_root)
    assert (record["status"], record["rows_validated"], record["rows_quarantined"]) == ("success", 1, 0)
    assert read_table(spark, f"{tmp_root}/gold", GOLD).count() == 1


def test_nightly_takes_a_file_that_appears_late(spark, tmp_root):
    write_raw(readings(spark, [("m1", "2024-01-01 00:00:10", 70.0, 0.5, 1.0, "s", 1)]), f"{tmp_root}/raw")
    _nightly(spark, tmp_root)
    write_raw(readings(spark, [("m2", "2024-01-01 00:00:10", 70.0, 0.5, 1.0, "s", 2)]), f"{tmp_root}/raw")
    for d, _, fs in os.walk(f"{tmp_root}/raw/date=2024-01-01/machine_id=m2"):
        for f in fs:
            os.utime(os.path.join(d, f), (1_000_000_000, 1_000_000_000))  # older than any run
    assert _nightly(spark, tmp_root)["files_seen"] == 1
    assert sorted(r["machine_id"] for r in read_table(spark, f"{tmp_root}/gold", GOLD).collect()) == ["m1", "m2"]


def test_nightly_that_died_is_repeated(spark, tmp_root, monkeypatch):
    import pytest

    from rotorwatch.plans import nightly
    from rotorwatch.schemas import QUARANTINE
    write_raw(readings(spark, [("m1", "2024-01-01 00:00:10", 70.0, 0.5, None, "s", 1),
                               ("m1", "2024-01-01 00:01:10", 70.0, 0.5, 1.0, "s", 2)]), f"{tmp_root}/raw")
    with monkeypatch.context() as m:
        m.setattr(nightly, "upsert", lambda *a: 1 / 0)
        with pytest.raises(Exception):
            _nightly(spark, tmp_root)
    record = _nightly(spark, tmp_root)
    assert (record["status"], record["rows_quarantined"]) == ("success", 1)
    assert read_table(spark, f"{tmp_root}/q", QUARANTINE).count() == 1
    assert read_table(spark, f"{tmp_root}/gold", GOLD).first()["total_readings"] == 1


def test_nightly_reports_missing_columns(spark, tmp_root):
    from rotorwatch.plans.nightly import report_path
    r = readings(spark, [("m1", "2024-01-01 00:00:10", 70.0, 0.5, 1.0, "s", 1)])
    write_raw(r.drop("vibration"), f"{tmp_root}/raw")
    _nightly(spark, tmp_root)
    found = spark.read.parquet(report_path(f"{tmp_root}/q")).collect()
    assert [(x["rows"], x["rows_quarantined"], x["missing_columns"]) for x in found] == [(1, 1, "vibration")]


def test_upsert_frees_its_scratch(spark, tmp_root):
    from rotorwatch.config import shared_dir
    scratch = lambda: {d for d in os.listdir(shared_dir(spark)) if d.startswith("upsert")}
    before = scratch()
    write_raw(readings(spark, [("m1", "2024-01-01 00:00:10", 70.0, 0.5, 1.0, "s", 1)]), f"{tmp_root}/raw")
    _nightly(spark, tmp_root)
    assert scratch() == before


def test_raw_zone_by_date_only_keeps_rows_and_clusters_machines(spark, tmp_root):
    from rotorwatch.config import Settings
    rows = [(f"m{i % 4}", f"2024-01-0{1 + i % 2} 00:00:{i:02d}", 70.0, 0.5, 1.0, "s", i) for i in range(40)]
    cfg = Settings(raw_partitions=("date",))
    write_raw(readings(spark, rows), f"{tmp_root}/raw", cfg)
    folders = sorted(d for d in os.listdir(f"{tmp_root}/raw") if not d.startswith(("_", ".")))
    assert folders == ["date=2024-01-01", "date=2024-01-02"]  # no machine_id= folders
    back = read_raw(spark, f"{tmp_root}/raw")
    assert sorted(r["event_id"] for r in back.collect()) == list(range(40))
    # inside every file, rows come in machine order
    files = {}
    for r in spark.read.parquet(f"{tmp_root}/raw").selectExpr(
            "_metadata.file_path AS f", "_metadata.row_index AS i", "machine_id").collect():
        files.setdefault(r["f"], []).append((r["i"], r["machine_id"]))
    for rows_in_file in files.values():
        machines = [m for _, m in sorted(rows_in_file)]
        assert machines == sorted(machines)
