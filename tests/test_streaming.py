import json
import os
import time

from pyspark.sql import functions as F

from rotorwatch.plans import hot_path
from rotorwatch.streaming import jobs


def _msg(machine, t, temp=70.0, vib=0.5):
    return json.dumps({"device_id": machine, "enqueued_time": t, "content_type": "application/json",
                       "body": {"machine_id": machine, "timestamp": t, "temperature": temp, "vibration": vib,
                                "rpm": 1500, "status": "running"}})


def _land(folder, name, lines, mtime):
    os.makedirs(folder, exist_ok=True)
    p = os.path.join(folder, name)
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(p, (mtime, mtime))  # file source order follows modification time


def test_late_rows_dropped_and_alerts_resume(spark, tmp_root):
    # G26 and restart from checkpoint (T4): three landings, the query stops after each
    land, hot, ckpt = f"{tmp_root}/in", f"{tmp_root}/hot", f"{tmp_root}/ckpt"
    now = time.time()
    landings = [
        ["m1 2024-01-01T00:01:00+00:00 96", "m1 2024-01-01T00:04:00+00:00 70"],
        # 00:02 is behind the newest time but its window (ending 00:05) is still open: counted
        ["m1 2024-01-01T00:09:00+00:00 70", "m1 2024-01-01T00:02:00+00:00 99"],
        # 00:03 arrives after the 00:05 window closed: dropped
        ["m1 2024-01-01T00:16:00+00:00 97", "m1 2024-01-01T00:03:00+00:00 98",
         "m1 2024-01-01T00:30:00+00:00 70", "bad {"],
    ]
    dropped = 0
    for i, batch in enumerate(landings):
        lines = []
        for item in batch:
            parts = item.split()
            lines.append(_msg(parts[0], parts[1], float(parts[2])) if len(parts) == 3 else item)
        _land(land, f"part-{i}.jsonl", lines, now - 100 + i)
        q = jobs.start_hot_path(jobs.message_stream(spark, land), hot, ckpt)
        q.awaitTermination()
        for p in q.recentProgress:
            dropped += sum(s.get("numRowsDroppedByWatermark", 0) for s in p["stateOperators"])
    assert dropped == 1
    status = {r["window_end"].strftime("%H:%M"): r["health_status"] for r in hot_path.read_status(spark, hot).collect()}
    # 00:30 is still open
    assert status == {"00:05": "ALERT", "00:10": "OK", "00:20": "ALERT"}
    alerts = sorted((r["triggered_at"].strftime("%H:%M"), r["resolved"], r["reason"])
                    for r in hot_path.read_alerts(spark, hot).collect())
    assert alerts == [("00:05", True, "max_vibration=0.50, max_temp=99.0"),
                      ("00:20", False, "max_vibration=0.50, max_temp=97.0")]


def test_raw_sink_and_corrupt_lines(spark, tmp_root):
    land = f"{tmp_root}/in"
    _land(land, "a.jsonl", [_msg("m1", "2024-01-01T00:01:00+00:00"), "{broken", "",
                            _msg("m2", "garbage")], time.time() - 10)
    raw_q, bad_q = jobs.start_raw_sink(jobs.message_stream(spark, land), f"{tmp_root}/raw",
                                       f"{tmp_root}/bad", f"{tmp_root}/ckpt")
    raw_q.awaitTermination()
    bad_q.awaitTermination()
    raw = spark.read.parquet(f"{tmp_root}/raw")
    assert [r["machine_id"] for r in raw.collect()] == ["m1"]
    assert [r["value"] for r in spark.read.parquet(f"{tmp_root}/bad").collect()] == ["{broken"]


def test_processing_time_trigger_matches_available_now(spark, tmp_root):
    # --watch style polling gives the same tables as a drain-and-stop run
    land = f"{tmp_root}/in"
    rows = [_msg("m1", f"2024-01-01T00:{m:02d}:00+00:00", 96.0 if m in (1, 12) else 70.0) for m in range(0, 30, 3)]
    _land(land, "a.jsonl", rows, time.time() - 10)
    polled = jobs.start_hot_path(jobs.message_stream(spark, land), f"{tmp_root}/hot_a", f"{tmp_root}/ck_a",
                                 trigger="1 second")
    polled.processAllAvailable()
    polled.stop()
    once = jobs.start_hot_path(jobs.message_stream(spark, land), f"{tmp_root}/hot_b", f"{tmp_root}/ck_b")
    once.awaitTermination()
    a = sorted(map(tuple, hot_path.read_status(spark, f"{tmp_root}/hot_a").collect()))
    b = sorted(map(tuple, hot_path.read_status(spark, f"{tmp_root}/hot_b").collect()))
    assert a and a == b
    assert sorted(map(tuple, hot_path.read_alerts(spark, f"{tmp_root}/hot_a").collect())) == \
        sorted(map(tuple, hot_path.read_alerts(spark, f"{tmp_root}/hot_b").collect()))


def test_fan_out_readers_keep_their_own_position(spark, tmp_root):
    # K4 + T7: raw sink and hot path read one landing folder with their own
    # checkpoints; a reader that is not restarted does not lose its place
    land, ckpt = f"{tmp_root}/in", f"{tmp_root}/ckpt"
    now = time.time()
    _land(land, "a.jsonl", [_msg("m1", "2024-01-01T00:01:00+00:00", 96.0),
                            _msg("m1", "2024-01-01T00:06:00+00:00")], now - 100)

    def raw_once():
        qs = jobs.start_raw_sink(jobs.message_stream(spark, land), f"{tmp_root}/raw", f"{tmp_root}/bad", ckpt)
        for q in qs:
            q.awaitTermination()

    def hot_once():
        jobs.start_hot_path(jobs.message_stream(spark, land), f"{tmp_root}/hot", ckpt).awaitTermination()

    raw_once()
    hot_once()
    _land(land, "b.jsonl", [_msg("m1", "2024-01-01T00:20:00+00:00")], now - 50)
    raw_once()  # only the raw reader moves on
    assert spark.read.parquet(f"{tmp_root}/raw").count() == 3
    assert [r["health_status"] for r in hot_path.read_status(spark, f"{tmp_root}/hot").collect()] == ["ALERT"]
    hot_once()  # the hot path resumes from its own position and sees b.jsonl once
    status = sorted((r["window_end"].strftime("%H:%M"), r["health_status"])
                    for r in hot_path.read_status(spark, f"{tmp_root}/hot").collect())
    assert status == [("00:05", "ALERT"), ("00:10", "OK")]
    assert spark.read.parquet(f"{tmp_root}/raw").count() == 3
    assert [(r["resolved"]) for r in hot_path.read_alerts(spark, f"{tmp_root}/hot").collect()] == [True]


def test_one_wild_clock_does_not_close_other_machines_windows(spark, tmp_root):
    land = f"{tmp_root}/in"
    wild = json.loads(_msg("m2", "2099-01-01T00:00:00+00:00"))
    wild["enqueued_time"] = "2024-01-01T00:01:30+00:00"
    now = time.time()
    _land(land, "a.jsonl", [_msg("m1", "2024-01-01T00:01:00+00:00"), json.dumps(wild)], now - 100)
    jobs.start_hot_path(jobs.message_stream(spark, land), f"{tmp_root}/hot", f"{tmp_root}/ckpt").awaitTermination()
    _land(land, "b.jsonl", [_msg("m1", "2024-01-01T00:02:00+00:00", 99.0), _msg("m1", "2024-01-01T00:20:00+00:00")], now - 50)
    lines = jobs.message_stream(spark, land)
    jobs.start_hot_path(lines, f"{tmp_root}/hot", f"{tmp_root}/ckpt").awaitTermination()
    jobs.start_ahead_sink(lines, f"{tmp_root}/ahead", f"{tmp_root}/ckpt").awaitTermination()
    alerts = hot_path.read_alerts(spark, f"{tmp_root}/hot").collect()
    assert [(r["machine_id"], r["triggered_at"].strftime("%H:%M")) for r in alerts] == [("m1", "00:05")]
    assert [r["machine_id"] for r in spark.read.parquet(f"{tmp_root}/ahead").collect()] == ["m2"]


def test_huge_values_do_not_stop_the_stream(spark, tmp_root):
    land = f"{tmp_root}/in"
    _land(land, "a.jsonl", [_msg("m1", "2024-01-01T00:01:00+00:00", 1e20), _msg("m2", "2024-01-01T00:20:00+00:00"),
                            _msg("m3", "2024-01-01T00:01:00+00:00", float("inf"))], time.time() - 10)
    jobs.start_hot_path(jobs.message_stream(spark, land), f"{tmp_root}/hot", f"{tmp_root}/ckpt").awaitTermination()
    status = {r["machine_id"]: (r["avg_temp"], r["health_status"]) for r in hot_path.read_status(spark, f"{tmp_root}/hot").collect()}
    assert status == {"m1": (1e20, "ALERT"), "m3": (None, "OK")}


def test_stream_and_batch_share_the_raw_zone(spark, tmp_root):
    from conftest import readings
    from rotorwatch.config import Settings
    from rotorwatch.sinks.raw import land_batch, raw_rows, write_raw
    from rotorwatch.sources.raw import read_raw
    land, raw = f"{tmp_root}/in", f"{tmp_root}/raw"
    _land(land, "a.jsonl", [_msg("m1", "2024-01-01T00:01:00+00:00")], time.time() - 10)
    for q in jobs.start_raw_sink(jobs.message_stream(spark, land), raw, f"{tmp_root}/bad", f"{tmp_root}/ckpt"):
        q.awaitTermination()
    batch = readings(spark, [("m2", "2024-01-01 00:02:00", 70.0, 0.5, 1.0, "s", 5), ("m2", "2024-01-02 00:02:00", 70.0, 0.5, 1.0, "s", 6)])
    write_raw(batch, raw)
    assert sorted(r["machine_id"] for r in read_raw(spark, raw).collect()) == ["m1", "m2", "m2"]
    assert read_raw(spark, raw).filter("event_id IS NULL").count() == 0  # streamed rows have a tie-breaker
    for _ in range(2):  # a repeated micro-batch
        land_batch(raw_rows(batch), raw, 7, f"{tmp_root}/other", Settings())
    assert read_raw(spark, raw).count() == 5
    # one that stopped when part of its folders were there
    land_batch(raw_rows(batch.filter("event_id = 5")), raw, 8, f"{tmp_root}/third", Settings())
    assert read_raw(spark, raw).count() == 6
    land_batch(raw_rows(batch), raw, 8, f"{tmp_root}/third", Settings())
    assert read_raw(spark, raw).count() == 7
    # a batch landing of a name replaces itself, one without is new
    for _ in range(2):
        write_raw(batch, raw, batch="night-1")
    assert read_raw(spark, raw).count() == 9
    write_raw(batch, raw)
    assert read_raw(spark, raw).count() == 11


def test_batches_follow_each_other(spark, tmp_root):
    """ALERT, then ALERT, OK: one alert, resolved; repeated batches change nothing."""
    from conftest import readings
    from rotorwatch.operators.windows import window_status
    first = window_status(readings(spark, [("m1", "2024-01-01 00:01:00", 99.0, 0.5, 1.0, "s", 1), ("m2", "2024-01-01 00:01:00", 99.0, 0.5, 1.0, "s", 2)]))
    then = window_status(readings(spark, [("m1", "2024-01-01 00:06:00", 98.0, 0.5, 1.0, "s", 3), ("m1", "2024-01-01 00:11:00", 70.0, 0.5, 1.0, "s", 4)]))
    for batch in (first, first, then, then):
        hot_path.write_batch(spark, batch, tmp_root)
    alerts = sorted((r["machine_id"], r["triggered_at"].strftime("%H:%M"), r["resolved"], r["reason"]) for r in hot_path.read_alerts(spark, tmp_root).collect())
    assert alerts == [("m1", "00:05", True, "max_vibration=0.50, max_temp=99.0"), ("m2", "00:05", False, "max_vibration=0.50, max_temp=99.0")]
    assert hot_path.read_status(spark, tmp_root).count() == 4


def test_a_clock_closes_the_windows_of_a_quiet_stream(spark, tmp_root):
    land, clock = f"{tmp_root}/in", f"{tmp_root}/clock"
    now = time.time()

    def run():
        q = jobs.start_hot_path(jobs.message_stream(spark, land), f"{tmp_root}/hot", f"{tmp_root}/ckpt", clock=jobs.clock_stream(spark, clock))
        q.awaitTermination()
        return {r["window_end"].strftime("%H:%M") for r in hot_path.read_status(spark, f"{tmp_root}/hot").collect()}

    _land(land, "a.jsonl", [_msg("m1", "2024-01-01T00:01:00+00:00", 99.0), _msg("m2", "2024-01-01T00:07:00+00:00")], now - 100)
    _land(clock, "a.txt", ["2024-01-01T00:07:00+00:00"], now - 100)
    assert run() == {"00:05"}
    _land(clock, "b.txt", ["2024-01-01T00:10:04+00:00", "no time"], now - 90)  # within the tolerance of the window's end
    assert run() == {"00:05"}
    _land(clock, "c.txt", ["2024-01-01T00:10:05+00:00"], now - 80)
    assert run() == {"00:05", "00:10"}
    assert hot_path.read_open_alerts(spark, f"{tmp_root}/hot").count() == 1
    _land(land, "d.jsonl", [_msg("m2", "2024-01-01T00:09:00+00:00", 99.0)], now - 70)  # after its window closed
    assert run() == {"00:05", "00:10"}
    assert hot_path.read_open_alerts(spark, f"{tmp_root}/hot").count() == 1


def test_a_message_delivered_twice_counts_once_and_is_forgotten_with_its_window(spark, tmp_root):
    land = f"{tmp_root}/in"
    now = time.time()
    first = [_msg("m1", "2024-01-01T00:01:00+00:00", 70.0), _msg("m1", "2024-01-01T00:02:00+00:00", 80.0)]
    for k, lines in enumerate([[first[0], first[0]], first, [first[0], _msg("m1", "2024-01-01T00:30:00+00:00")], [_msg("m1", "2024-01-01T00:50:00+00:00")]]):
        _land(land, f"{k}.jsonl", lines, now - 100 + k)
        q = jobs.start_hot_path(jobs.message_stream(spark, land), f"{tmp_root}/hot", f"{tmp_root}/ckpt")
        q.awaitTermination()
    status = {r["window_end"].strftime("%H:%M"): r["avg_temp"] for r in hot_path.read_status(spark, f"{tmp_root}/hot").collect()}
    assert status == {"00:05": 75.0, "00:30": 70.0}
    rows = [s["numRowsTotal"] for s in q.lastProgress["stateOperators"]]
    assert rows == [1, 1]  # the open window's message, and its sums


def test_devices_registered_while_the_stream_runs(spark, tmp_root):
    land, registry = f"{tmp_root}/in", f"{tmp_root}/devices"
    schema = "device_id string, registered boolean, valid_from timestamp"

    def register(rows):
        spark.createDataFrame(rows, "device_id string, registered boolean, t string").selectExpr(
            "device_id", "registered", "to_timestamp(t) AS valid_from").write.mode("append").parquet(registry)

    def drain():
        raw_q, bad_q = jobs.start_raw_sink(jobs.message_stream(spark, land), f"{tmp_root}/raw", f"{tmp_root}/bad",
                                           f"{tmp_root}/ckpt", registry=registry, rejected_path=f"{tmp_root}/rejected")
        raw_q.awaitTermination()
        bad_q.awaitTermination()

    def landed(name):
        return sorted((r["machine_id"], r["event_time"].strftime("%H:%M")) for r in spark.read.parquet(f"{tmp_root}/{name}").collect())

    spark.createDataFrame([], schema).write.parquet(registry)
    register([("m1", True, None), ("m2", False, None), ("m4", True, "2024-01-01T00:00:00Z"), ("m4", False, "2024-01-01T00:10:00Z"),
              ("m5", True, None), ("m5", False, None), ("m6", None, None), (None, True, None)])
    _land(land, "a.jsonl", [_msg(m, f"2024-01-01T00:0{k}:00+00:00") for k in (1, 5) for m in ("m1", "m2", "m3", "m4", "m5", "m6")], time.time() - 10)
    drain()
    assert landed("raw") == [("m1", "00:01"), ("m1", "00:05"), ("m4", "00:01"), ("m4", "00:05")]
    assert landed("rejected") == sorted((m, t) for m in ("m2", "m3", "m5", "m6") for t in ("00:01", "00:05"))
    # m3 is registered as of 00:10, m4 refused as of then
    register([("m3", True, "2024-01-01T00:10:00Z")])
    _land(land, "b.jsonl", [_msg(m, t) for t in ("2024-01-01T00:09:59+00:00", "2024-01-01T00:10:00+00:00") for m in ("m3", "m4")], time.time() - 5)
    drain()
    assert landed("raw")[2:] == [("m3", "00:10"), ("m4", "00:01"), ("m4", "00:05"), ("m4", "00:09")]
    assert ("m3", "00:09") in landed("rejected") and ("m4", "00:10") in landed("rejected")
    assert len(landed("raw")) + len(landed("rejected")) == 16
