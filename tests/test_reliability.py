from conftest import naive, readings, ts

from rotorwatch.operators.quality import conform, missing_columns, split_valid, validation_summary
from rotorwatch.operators.reliability import daily_reliability, dedup_latest


def test_latest_per_minute_and_ties(spark):
    r = readings(spark, [
        ("m1", "2024-01-01 00:00:10", 70.0, 0.5, 1.0, "s", 1),   # G15: 10 s and 50 s -> 50 s kept
        ("m1", "2024-01-01 00:00:50", 71.0, 0.5, 1.0, "s", 2),
        ("m1", "2024-01-01 00:01:05", 72.0, 0.5, 1.0, "s", 3),   # G16: same time twice -> higher id
        ("m1", "2024-01-01 00:01:05", 73.0, 0.5, 1.0, "s", 4),
        (None, "2024-01-01 00:01:05", 73.0, 0.5, 1.0, "s", 5),   # null machine dropped
        ("m1", None, 73.0, 0.5, 1.0, "s", 6),                     # null time dropped
    ])
    kept = sorted(x["event_id"] for x in dedup_latest(r).collect())
    assert kept == [2, 4]


def test_daily_rules(spark):
    r = readings(spark, [
        ("m1", "2024-01-01 00:00:10", 90.0, 1.8, 1.0, "s", 1),   # G17 limits exactly: not anomalous
        ("m1", "2024-01-01 00:01:10", 91.0, None, 1.0, "s", 2),  # G18 null vib, hot: anomalous
        ("m1", "2024-01-01 00:02:10", 80.0, None, 1.0, "s", 3),  # G18 null vib, cool: not
        ("m1", "2024-01-01 00:03:10", 80.0, 0.5, 1.0, "s", 4),
    ])
    row = daily_reliability(r, gated=False).first()
    assert (row["total_readings"], row["anomaly_count"], row["uptime_score"]) == (4, 1, 0.75)  # G19
    assert row["avg_daily_vibration"] == (1.8 + 0.5) / 2


def test_gate(spark):
    # Null rpm -> quarantined, absent from the gated daily run
    r = readings(spark, [("m1", "2024-01-01 00:00:10", 70.0, 0.5, None, "s", 1),
                         ("m1", "2024-01-01 00:01:10", 70.0, 0.5, 1.0, "s", 2)])
    valid, bad = split_valid(r)
    assert [x["event_id"] for x in bad.collect()] == [1]
    assert daily_reliability(r, gated=True).first()["total_readings"] == 1
    assert daily_reliability(r, gated=False).first()["total_readings"] == 2
    s = validation_summary(r).first()
    assert (s["rows_validated"], s["rows_quarantined"]) == (2, 1)


def test_missing_column_quarantines_all(spark):
    # G24
    r = readings(spark, [("m1", "2024-01-01 00:00:10", 70.0, 0.5, 1.0, "s", 1)]).drop("vibration")
    assert missing_columns(r.schema) == ["vibration"]
    valid, bad = split_valid(r)
    assert valid.count() == 0 and bad.count() == 1
    assert "vibration" in conform(r).columns


def test_validation_report_lists_missing_columns(spark):
    # A file without a vibration column is reported per file, its rows quarantined
    from pyspark.sql import functions as F
    from rotorwatch.operators.quality import validation_report
    full = readings(spark, [("m1", "2024-01-01 00:00:10", 70.0, 0.5, 1500.0, "s", 1),
                            ("m1", "2024-01-01 00:00:20", 70.0, 0.6, None, "s", 2)]).withColumn("source_file", F.lit("a"))
    lacking = readings(spark, [("m2", "2024-01-01 00:00:10", 71.0, None, 1500.0, "s", 3)]) \
        .drop("vibration").withColumn("source_file", F.lit("b"))
    report = {r["source_file"]: (r["rows"], r["rows_quarantined"], r["missing_columns"])
              for r in validation_report(full.unionByName(lacking, allowMissingColumns=True), ["source_file"]).collect()}
    assert report == {"a": (2, 1, ""), "b": (1, 1, "vibration")}
