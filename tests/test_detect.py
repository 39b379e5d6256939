import random
from collections import Counter

import pandas as pd
from conftest import readings
from pyspark.sql import Window
from pyspark.sql import functions as F

from rotorwatch.config import Settings
from rotorwatch.operators.sequence import CARRY, frame, with_preceding


def _series(spark, seed=7, machines=3, rows=400):
    rnd = random.Random(seed)
    data = []
    for i in range(rows):
        m = f"m{rnd.randrange(machines)}"
        data.append((m, rnd.randrange(0, 40), i, rnd.random()))  # bucket ids 0..39: many tiny buckets
    return spark.createDataFrame(data, "machine_id string, b int, seq_key long, v double")


def test_bucketed_frames_equal_per_key_window(spark):
    df = _series(spark)
    for n in (1, 5, 30):
        framed = with_preceding(df, ["machine_id"], ["b", "seq_key"], "b", n)
        got = (framed.select("machine_id", "seq_key", CARRY,
                             F.collect_list("v").over(frame(["machine_id"], ["b", "seq_key"]).rowsBetween(-n, -1)).alias("prev"))
               .filter(~F.col(CARRY)).drop(CARRY))
        w = Window.partitionBy("machine_id").orderBy("b", "seq_key").rowsBetween(-n, -1)
        want = df.select("machine_id", "seq_key", F.collect_list("v").over(w).alias("prev"))
        a = {r["seq_key"]: r["prev"] for r in got.collect()}
        b = {r["seq_key"]: r["prev"] for r in want.collect()}
        assert a == b, n


def test_rate_of_change_brute_force(spark):
    from conftest import readings
    from rotorwatch.operators.detect import rate_of_change
    rows = [("m1", "2024-01-01 00:00:00", 70.0, 0.5, 1.0, "s", 1),
            ("m1", "2024-01-01 00:59:59", 70.0, 2.0, 1.0, "s", 2),   # +1.5 over 3599 s
            ("m1", "2024-01-01 01:00:01", 70.0, None, 1.0, "s", 3),  # null vibration skipped
            ("m1", "2024-01-01 03:00:01", 70.0, 0.4, 1.0, "s", 4),   # -1.6, two buckets later
            ("m1", "2024-01-01 03:00:01", 70.0, 2.0, 1.0, "s", 5)]   # zero time step: not scored
    out = {r["event_id"]: r for r in rate_of_change(readings(spark, rows), Settings(roc_limit=1.0)).collect()}
    assert sorted(out) == [2, 4]
    assert out[4]["prev_vibration"] == 2.0 and out[4]["rate_per_s"] == (0.4 - 2.0) / 7202


def test_zscore_brute_force(spark):
    from conftest import readings
    from rotorwatch.operators.detect import zscore_anomaly
    rnd = random.Random(3)
    rows = []
    for i in range(120):
        v = round(0.5 + rnd.random() / 10, 3) if i != 90 else 3.0
        rows.append(("m1", f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00", 70.0, v, 1.0, "s", i))
    got = {r["event_id"] for r in zscore_anomaly(readings(spark, rows), Settings(sequence_bucket_rows=3)).collect()}
    s = pd.Series([r[3] for r in rows])
    want = set()
    for i in range(30, len(s)):
        win = s[i - 30:i]
        if win.std() > 0 and abs(s[i] - win.mean()) / win.std() > 3:
            want.add(i)
    assert got == want and 90 in got


def test_hot_machine_is_spread_over_tasks(spark):
    """A machine with a third of all rows: per-key frames run in many tasks,
    while a plain per-machine window would put the whole machine in one."""
    rows = []
    for i in range(3000):
        m = "hot" if i % 3 == 0 else f"m{i % 50}"
        rows.append((m, i // 30, i, float(i % 17)))  # 100 time buckets
    df = spark.createDataFrame(rows, "machine_id string, b int, seq_key long, v double")
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        framed = with_preceding(df, ["machine_id"], ["b", "seq_key"], "b", 30)
        per_task = (framed.filter(~F.col(CARRY))
                    .select("machine_id", F.sum("v").over(frame(["machine_id"], ["b", "seq_key"]).rowsBetween(-30, -1)).alias("s"))
                    .select("machine_id", "s", F.spark_partition_id().alias("pid")).collect())
        plain = (df.select("machine_id", F.sum("v").over(Window.partitionBy("machine_id").orderBy("b", "seq_key"))
                           .alias("s"))
                 .select("machine_id", "s", F.spark_partition_id().alias("pid")).collect())
    finally:
        spark.conf.set(conf, old)
    hot_plain = Counter(r["pid"] for r in plain if r["machine_id"] == "hot")
    hot_split = Counter(r["pid"] for r in per_task if r["machine_id"] == "hot")
    assert len(hot_plain) == 1                  # per-machine window: one task holds the hot machine
    assert len(hot_split) >= 3                  # bucketed frames: spread over several tasks
    assert max(hot_split.values()) < 0.6 * sum(hot_split.values())


def test_rank_buckets_equal_per_key_window(spark):
    """A dense machine, sparse ones, a burst and one 1970 row: buckets never exceed the target, frames are exact."""
    from rotorwatch.operators.sequence import rank_buckets
    rnd = random.Random(11)
    rows = [("dense", 0, -1, 0.5)]                                  # a wild clock
    for i in range(2400):
        if i % 2 == 0:
            m, t = "dense", 1_700_000_000 + (i * 10 if i < 1200 else 12_000)   # every 20 s, then a burst
        else:
            m, t = f"s{i % 7}", 1_700_000_000 + rnd.randrange(0, 24000) * 1000
        rows.append((m, t, i, rnd.random()))
    df = (spark.createDataFrame(rows, "machine_id string, t long, seq_key long, v double")
          .withColumn("event_time", F.timestamp_seconds("t")))
    order = ["event_time", "seq_key"]
    for target in (3, 40):
        b = rank_buckets(df, ["machine_id"], order, target, out="b")
        assert max(r["count"] for r in b.groupBy("b").count().collect()) <= target
        for n in (1, 30):
            framed = with_preceding(b, ["machine_id"], order, "b", n)
            got = (framed.select("seq_key", CARRY, F.collect_list("v").over(
                       frame(["machine_id"], order).rowsBetween(-n, -1)).alias("prev"))
                   .filter(~F.col(CARRY)))
            w = Window.partitionBy("machine_id").orderBy(*order).rowsBetween(-n, -1)
            want = df.select("seq_key", F.collect_list("v").over(w).alias("prev"))
            assert {r["seq_key"]: r["prev"] for r in got.collect()} == \
                   {r["seq_key"]: r["prev"] for r in want.collect()}, (target, n)


def test_rank_buckets_spread_a_hot_machine(spark):
    """A machine with a third of all rows is evaluated in several tasks."""
    from rotorwatch.operators.sequence import rank_buckets
    rows = [("hot" if i % 3 == 0 else f"m{i % 50}", i, i, float(i % 17)) for i in range(3000)]
    df = (spark.createDataFrame(rows, "machine_id string, t long, seq_key long, v double")
          .withColumn("event_time", F.timestamp_seconds("t")))
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        b = rank_buckets(df, ["machine_id"], ["event_time", "seq_key"], 50, out="b")
        framed = with_preceding(b, ["machine_id"], ["event_time", "seq_key"], "b", 30)
        pids = Counter(r["pid"] for r in framed.filter(~F.col(CARRY) & (F.col("machine_id") == "hot"))
                       .select(F.spark_partition_id().alias("pid")).collect())
    finally:
        spark.conf.set(conf, old)
    assert len(pids) >= 3 and max(pids.values()) < 0.6 * sum(pids.values())


def test_zscore_keeps_digits_and_takes_large_values(spark):
    """Values far apart in size: no digit dropped, nothing overflows, a small spread on a large value does not cancel."""
    rows = [("m", f"2024-01-01 00:{i:02d}:00", 1.0, 1e9 + (i % 2) * 1e-3, 1.0, "running", i) for i in range(31)]
    rows += [("m", "2024-01-01 00:40:00", 1.0, 1e9 + 1.0, 1.0, "running", 99),
             ("big", "2024-01-01 00:40:00", 1.0, 1e20, 1.0, "running", 100)]
    from rotorwatch.operators.detect import zscore_anomaly
    got = zscore_anomaly(readings(spark, rows)).collect()
    assert [r["event_id"] for r in got] == [99]
    assert 0.0004 < got[0]["std_vibration"] < 0.0006
