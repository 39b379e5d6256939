import datetime as dt

import pytest
from conftest import readings, ts

from rotorwatch.operators.windows import closed_windows, window_status


def _one(spark, rows):
    return {r["machine_id"] + "@" + r["window_end"].isoformat(): r.asDict()
            for r in window_status(readings(spark, rows)).collect()}


def test_right_closed_edges(spark):
    # Exactly on the edge belongs to the window ending there
    out = _one(spark, [("m1", "2024-01-01 00:05:00", 70.0, 0.5, 1500.0, "running", 1),
                       ("m1", "2024-01-01 00:05:00.000001", 71.0, 0.5, 1500.0, "running", 2)])
    assert set(out) == {"m1@2024-01-01T00:05:00", "m1@2024-01-01T00:10:00"}


def test_strict_limits_and_nulls(spark):
    out = _one(spark, [
        ("m1", "2024-01-01 00:01:00", 95.0, 2.0, 1500.0, "running", 1),   # G3: limits exactly -> OK
        ("m2", "2024-01-01 00:01:00", 96.0, None, 1500.0, "running", 2),  # G4: null vib, hot -> ALERT
        ("m3", "2024-01-01 00:01:00", 70.0, None, 1500.0, "running", 3),  # G5: null vib -> OK
        ("m4", None, 99.0, 9.0, 1500.0, "running", 4),                    # G9: no time -> no window
    ])
    assert out["m1@2024-01-01T00:05:00"]["health_status"] == "OK"
    g4 = out["m2@2024-01-01T00:05:00"]
    assert g4["health_status"] == "ALERT" and g4["avg_vibration"] is None and g4["max_vibration"] is None
    assert out["m3@2024-01-01T00:05:00"]["health_status"] == "OK"
    assert not any(k.startswith("m4@") for k in out)


def test_average(spark):
    out = _one(spark, [("m1", "2024-01-01 00:01:00", 70.1, 0.1, 1.0, "s", 1),
                       ("m1", "2024-01-01 00:02:00", 70.2, 0.2, 1.0, "s", 2),
                       ("m1", "2024-01-01 00:03:00", 70.3, None, 1.0, "s", 3)])
    row = out["m1@2024-01-01T00:05:00"]
    assert row["avg_temp"] == pytest.approx(70.2, abs=1e-12) and row["avg_vibration"] == pytest.approx(0.15, abs=1e-12)


def test_closed_windows_tolerance(spark):
    # window_end = as_of - 5 s is closed; 1 µs earlier as_of leaves it open
    r = readings(spark, [("m1", "2024-01-01 00:04:00", 70.0, 0.5, 1.0, "s", 1)])
    as_of = ts("2024-01-01 00:05:05")
    assert closed_windows(r, as_of).count() == 1
    assert closed_windows(r, as_of - dt.timedelta(microseconds=1)).count() == 0


def test_averages_keep_every_digit_and_take_any_finite_value(spark):
    out = _one(spark, [("tiny", "2024-01-01 00:01:00", 70.0, 0.00004, 1.0, "s", 1), ("tiny", "2024-01-01 00:02:00", 70.00004, 0.00004, 1.0, "s", 2),
                       ("huge", "2024-01-01 00:01:00", 1e20, 0.1, 1.0, "s", 3), ("huge", "2024-01-01 00:02:00", 3e20, 0.1, 1.0, "s", 4)])
    tiny, huge = out["tiny@2024-01-01T00:05:00"], out["huge@2024-01-01T00:05:00"]
    assert tiny["avg_vibration"] == pytest.approx(0.00004, rel=1e-12) and tiny["avg_temp"] == pytest.approx(70.00002, abs=1e-12)
    assert huge["avg_temp"] == pytest.approx(2e20) and huge["health_status"] == "ALERT"


def test_tolerance_keeps_its_unit(spark):
    import datetime as dt

    from rotorwatch.config import Settings, duration
    from rotorwatch.operators.windows import closed_windows
    r = readings(spark, [("m", "2024-01-01 00:01:00", 70.0, 0.5, 1.0, "s", 1)])
    at = dt.datetime(2024, 1, 1, 0, 5, 10)
    assert closed_windows(r, at, Settings(tolerance="2 minutes")).count() == 0
    assert closed_windows(r, at, Settings(tolerance="2 seconds")).count() == 1
    assert duration("1 minute 30 seconds") == dt.timedelta(seconds=90)
    with pytest.raises(ValueError):
        duration("5")
