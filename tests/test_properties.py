"""Property tests: valid ∪ quarantined = input, results do not
depend on input order or partitioning, upsert twice = upsert once."""

import datetime as dt

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rotorwatch.config import scratch_path
from rotorwatch.operators.quality import split_valid, validation_summary
from rotorwatch.operators.reliability import daily_reliability
from rotorwatch.operators.windows import window_status
from rotorwatch.schemas import GOLD, READING
from rotorwatch.sinks.tables import upsert
from rotorwatch.sources.raw import read_table

SCHEMA = T.StructType(READING.fields + [T.StructField("event_id", T.LongType())])
START = dt.datetime(2024, 1, 1, 23, 50, tzinfo=dt.timezone.utc)  # windows and dates both cross midnight
# each example runs Spark jobs: few examples, and no shrinking (a failing case is small already)
SETTINGS = settings(max_examples=8, deadline=None, phases=[Phase.explicit, Phase.reuse, Phase.generate],
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def maybe(s):
    return st.one_of(st.none(), s)


reading = st.tuples(
    maybe(st.sampled_from(["m1", "m2", "m3"])),
    maybe(st.integers(0, 1200).map(lambda s: START + dt.timedelta(seconds=s))),
    maybe(st.integers(6000, 10000).map(lambda c: c / 100)),
    maybe(st.integers(100, 2500).map(lambda m: m / 1000)),
    maybe(st.integers(1200, 1800).map(float)),
    maybe(st.sampled_from(["running", "warning"])),
)
readings_st = st.lists(reading, min_size=1, max_size=60)


def frame(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@SETTINGS
@given(rows=readings_st)
def test_valid_and_quarantined_partition_the_input(spark, rows):
    df = frame(spark, rows)
    valid, bad = split_valid(df)
    v = [r["event_id"] for r in valid.collect()]
    b = [r["event_id"] for r in bad.collect()]
    assert sorted(v + b) == list(range(len(rows))) and not set(v) & set(b)
    summary = validation_summary(df).first()
    assert (summary["rows_validated"], summary["rows_quarantined"]) == (len(rows), len(b))


@SETTINGS
@given(rows=readings_st, seed=st.integers(0, 1000), parts=st.integers(1, 5))
def test_results_do_not_depend_on_order_or_partitioning(spark, rows, seed, parts):
    df = frame(spark, rows)
    shuffled = df.orderBy(F.rand(seed)).repartition(parts)
    assert rows_of(window_status(df)) == rows_of(window_status(shuffled))
    for gated in (True, False):
        assert rows_of(daily_reliability(df, gated=gated)) == rows_of(daily_reliability(shuffled, gated=gated))


gold_row = st.tuples(st.sampled_from(["m1", "m2", "m3"]), st.integers(0, 3), st.integers(1, 50))


@SETTINGS
@given(existing=st.lists(gold_row, max_size=8, unique_by=lambda r: r[:2]),
       incoming=st.lists(gold_row, max_size=8, unique_by=lambda r: r[:2]))
def test_upsert_twice_equals_once(spark, existing, incoming):
    def gold(rows):
        data = [(m, dt.date(2024, 1, 1) + dt.timedelta(days=d), n, 0, 70.0, 0.5, 1.0) for m, d, n in rows]
        return spark.createDataFrame(data, GOLD)

    keys = ["machine_id", "date"]
    root = scratch_path(spark, "upsert-property")  # fresh per example
    once, twice = f"{root}/once", f"{root}/twice"
    for path, times in ((once, 1), (twice, 2)):
        upsert(spark, path, gold(existing), keys, "date", GOLD)
        for _ in range(times):
            upsert(spark, path, gold(incoming), keys, "date", GOLD)
    assert rows_of(read_table(spark, once, GOLD)) == rows_of(read_table(spark, twice, GOLD))
    # incoming rows replace, other keys stay
    want = {(m, d): n for m, d, n in existing}
    want.update({(m, d): n for m, d, n in incoming})
    got = sorted((r["machine_id"], (r["date"] - dt.date(2024, 1, 1)).days, r["total_readings"])
                 for r in read_table(spark, once, GOLD).collect())
    assert got == sorted((m, d, n) for (m, d), n in want.items())
