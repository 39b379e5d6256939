import datetime as dt

from conftest import naive, ts

from rotorwatch.operators.reports import latest_status, status_grid, unresolved_count, uptime_pivot
from rotorwatch.schemas import ALERT, GOLD, STATUS


def test_latest_and_label(spark):
    rows = [("m1", ts("2024-01-01 00:05:00"), 71.25, 72.0, None, None, "OK"),
            ("m1", ts("2024-01-01 00:10:00"), 71.24, 72.0, None, None, "OK"),   # G27 later wins
            ("m2", ts("2024-01-01 00:05:00"), 70.0, 72.0, 0.445, 0.5, "ALERT")]
    s = spark.createDataFrame(rows, STATUS)
    latest = {r["machine_id"]: naive(r["window_end"]) for r in latest_status(s).collect()}
    assert latest["m1"] == dt.datetime(2024, 1, 1, 0, 10)
    grid = [(r["machine_id"], r["label"]) for r in status_grid(s).collect()]
    assert grid == [("m1", "71.2°C"), ("m2", "70.0°C / vib 0.45")]  # G28


def test_unresolved_and_pivot(spark):
    a = spark.createDataFrame([(1, "m1", ts("2024-01-01 00:05:00"), "r", True),
                               (2, "m1", ts("2024-01-01 00:20:00"), "r", False)], ALERT)
    assert unresolved_count(a).first()["unresolved"] == 1
    g = spark.createDataFrame([("m1", dt.date(2024, 1, 1), 4, 1, 70.0, 0.5, 0.75),
                               ("m2", dt.date(2024, 1, 1), 4, 0, 70.0, 0.5, 1.0)], GOLD)
    p = uptime_pivot(g, ["m1", "m2", "m3"]).first().asDict()
    assert p == {"date": dt.date(2024, 1, 1), "m1": 0.75, "m2": 1.0, "m3": None}
