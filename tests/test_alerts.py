from conftest import naive, ts

from rotorwatch.operators.alerts import alert_lifecycle
from rotorwatch.schemas import STATUS


def _status(spark, seq, machine="m1"):
    """seq: list of (window_end text, health_status) for one machine."""
    rows = [(machine, ts(t), 70.0, 96.0 if h == "ALERT" else 70.0, 0.5, 2.675, h) for t, h in seq]
    return spark.createDataFrame(rows, STATUS)


def _alerts(df):
    return sorted((naive(r["triggered_at"]).isoformat(), r["resolved"], r["reason"])
                  for r in alert_lifecycle(df).collect())


def test_alert_alert_ok_alert(spark):
    # G12
    out = _alerts(_status(spark, [("2024-01-01 00:05:00", "ALERT"), ("2024-01-01 00:10:00", "ALERT"),
                                  ("2024-01-01 00:15:00", "OK"), ("2024-01-01 00:20:00", "ALERT")]))
    assert [(t, res) for t, res, _ in out] == [("2024-01-01T00:05:00", True), ("2024-01-01T00:20:00", False)]
    assert out[0][2] == "max_vibration=2.68, max_temp=96.0"  # decimal half-up


def test_gap_keeps_alert_open(spark):
    # A window without data changes nothing
    out = _alerts(_status(spark, [("2024-01-01 00:05:00", "ALERT"), ("2024-01-01 00:15:00", "ALERT")]))
    assert [(t, res) for t, res, _ in out] == [("2024-01-01T00:05:00", False)]


def test_ok_first_no_alert(spark):
    # G14
    assert _alerts(_status(spark, [("2024-01-01 00:05:00", "OK")])) == []


def test_missing_max_reads_nan(spark):
    rows = [("m1", ts("2024-01-01 00:05:00"), 96.0, 96.0, None, None, "ALERT")]
    out = alert_lifecycle(spark.createDataFrame(rows, STATUS)).first()
    assert out["reason"] == "max_vibration=nan, max_temp=96.0"
