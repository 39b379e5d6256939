import json

from conftest import naive, readings, ts

from rotorwatch.config import Settings
from rotorwatch.operators.ingest import (encode_envelopes, parse_envelopes, reading_payload,
                                         split_registered)


def _lines(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "event_id long, value string")


def _env(body, device="dev-1", enq="2024-01-01T00:00:09+00:00"):
    return json.dumps({"device_id": device, "enqueued_time": enq, "content_type": "application/json",
                       "body": body})


def test_parse_fallbacks_and_bad_lines(spark):
    lines = _lines(spark, [
        _env({"machine_id": "", "timestamp": "2024-01-01T00:00:01.123456+00:00", "temperature": 70.5,
              "vibration": 0.4, "rpm": 1500, "status": "running"}),                     # G8
        _env({"machine_id": "m2", "timestamp": "garbage", "temperature": 70.0}),         # G9
        _env({"machine_id": "m3", "timestamp": "2024-01-01T00:05:00+00:00"}),            # G10 no fraction
        _env({"machine_id": "m4", "temperature": 70.0}),                                  # no time -> enqueued
        '{"device_id": "dev-9", "body": {"machine_id": "m9"',                             # G11 truncated
        "   ",                                                                            # G11 blank
        _env({"machine_id": "m5", "timestamp": "2024-01-01T00:00:02+00:00", "vibration": float("nan")}),
    ])
    good, bad = parse_envelopes(lines, keep=("event_id",))
    rows = {r["event_id"]: r for r in good.collect()}
    assert rows[0]["machine_id"] == "dev-1" and naive(rows[0]["event_time"]) == naive(ts("2024-01-01 00:00:01.123456"))
    assert rows[0]["rpm"] == 1500.0
    assert rows[1]["event_time"] is None
    assert naive(rows[2]["event_time"]) == naive(ts("2024-01-01 00:05:00"))
    assert naive(rows[3]["event_time"]) == naive(ts("2024-01-01 00:00:09"))
    assert rows[6]["vibration"] is None  # G6: NaN is treated as missing
    assert [r["event_id"] for r in bad.collect()] == [4]
    assert 5 not in rows


def test_each_line_in_one_output_and_parsed_once(spark):
    # a wrongly typed body field makes the line corrupt, also when the corrupt
    # side is counted on its own (no column of it is selected)
    lines = _lines(spark, [
        _env({"machine_id": "m1", "timestamp": "2024-01-01T00:00:01+00:00", "temperature": "hot"}),
        _env({"machine_id": "m2", "timestamp": "2024-01-01T00:00:02+00:00", "temperature": 70.0}),
        "", "null", "{broken",
    ])
    good, bad = parse_envelopes(lines, keep=("event_id",))
    assert bad.count() == 3  # "null" is not an envelope object either
    assert sorted(r["event_id"] for r in bad.collect()) == [0, 3, 4]
    assert [r["event_id"] for r in good.collect()] == [1]
    # the corrupt split and the null filters stay above the parse: one from_json per line
    plan = good.filter(good["event_time"].isNotNull())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_enqueued_time_source(spark):
    lines = _lines(spark, [_env({"machine_id": "m1", "timestamp": "2024-01-01T00:00:01+00:00"})])
    good, _ = parse_envelopes(lines, Settings(time_source="enqueued"))
    assert naive(good.first()["event_time"]) == naive(ts("2024-01-01 00:00:09"))


def test_encode_roundtrip_drops_null_fields(spark):
    r = readings(spark, [("m1", "2024-01-01 00:00:01.5", 70.25, None, 1500.0, "running", 7)])
    lines = encode_envelopes(reading_payload(r), keep=("event_id",))
    text = lines.first()["value"]
    assert '"vibration"' not in text
    back, bad = parse_envelopes(lines, keep=("event_id",))
    assert bad.count() == 0
    row = back.first()
    assert (row["machine_id"], row["temperature"], row["vibration"], row["rpm"]) == ("m1", 70.25, None, 1500.0)
    assert naive(row["event_time"]) == naive(ts("2024-01-01 00:00:01.5"))


def test_registered_split(spark):
    # G25
    r = readings(spark, [("m1", "2024-01-01 00:00:01", 70.0, 0.5, 1.0, "s", 1),
                         ("m2", "2024-01-01 00:00:01", 70.0, 0.5, 1.0, "s", 2)])
    devices = spark.createDataFrame([("m1", True), ("m2", False)], "device_id string, registered boolean")
    ok, rejected = split_registered(r, devices)
    assert [x["machine_id"] for x in ok.collect()] == ["m1"]
    assert [x["machine_id"] for x in rejected.collect()] == ["m2"]


def test_adjust_late_policy(spark):
    # device clock 20 s behind arrival -> moved up to arrival - 5 s; 3 s behind -> kept
    lines = _lines(spark, [
        _env({"machine_id": "m1", "timestamp": "2024-01-01T00:00:40+00:00"}, enq="2024-01-01T00:01:00+00:00"),
        _env({"machine_id": "m1", "timestamp": "2024-01-01T00:00:57+00:00"}, enq="2024-01-01T00:01:00+00:00"),
        _env({"machine_id": "m1", "timestamp": "garbage"}, enq="2024-01-01T00:01:00+00:00"),
    ])
    good, _ = parse_envelopes(lines, Settings(late_policy="adjust"), keep=("event_id",))
    got = {r["event_id"]: naive(r["event_time"]) for r in good.collect()}
    assert got == {0: naive(ts("2024-01-01 00:00:55")), 1: naive(ts("2024-01-01 00:00:57")), 2: None}


def test_anything_after_the_first_value_makes_a_line_malformed(spark):
    one = '{"device_id": "m1", "enqueued_time": "2024-01-01T00:00:00+00:00", "body": {"temperature": NaN}}'
    lines = [one, one + one, one + " junk", one + "," + one, one + "]", "[" + one + "]", "", "  ", " " + one + "  ", "null", "7", '"x"', "[]", "{}", one[:-3]]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(lines)], "event_id int, value string")
    good, bad = parse_envelopes(df, keep=("event_id",))
    assert sorted(r["event_id"] for r in good.collect()) == [0, 8, 13]  # {}: a message without any field
    assert {r["event_id"]: r["value"] for r in bad.collect()} == {k: lines[k] for k in (1, 2, 3, 4, 5, 9, 10, 11, 12, 14)}


def test_a_line_cannot_close_the_object_it_is_parsed_in(spark):
    good = '{"device_id":"m1","enqueued_time":"2024-01-01T00:01:00+00:00","body":{"machine_id":"m1"}}'
    lines = spark.createDataFrame([(good,), (good + ',"_end":1} trailing junk',), (good + ',"_end":1}',), (good + " junk",)], "value string")
    good_ones, corrupt = parse_envelopes(lines)
    assert good_ones.count() == 1 and corrupt.count() == 3
