"""Exact averages: against fractions, and the same bits under any order and partitioning."""

import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from rotorwatch.functions import partial_means, whole_mean


def _means(df):
    parts = partial_means(df, ["g"], {"x": "m"})
    return {r["g"]: r["m"] for r in parts.groupBy("g").agg(whole_mean("m").alias("m")).collect()}


def _values(rng, kind, n):
    draw = [lambda: round(rng.uniform(60, 130), 2), lambda: rng.uniform(-3, 3), lambda: rng.choice([1e20, -1e20, 1.0, 5e-324, -5e-324, 3.3]),
            lambda: rng.choice([1e308, -1e308, 1.0, 1e-300, 2.2e-308, 7e-310]), lambda: rng.choice([None, 0.0, -0.0, 0.1]),
            lambda: rng.uniform(-1, 1) * 2.0 ** rng.randint(-1070, 1020), lambda: rng.choice([None, float("nan"), float("inf"), 2.0])][kind]
    return [draw() for _ in range(n)]


def _mean(xs):
    """The exact sum rounded to 53 bits, of whatever exponent, over the count."""
    if not xs:
        return None
    total = sum(map(Fraction, xs))
    if not total:
        return 0.0
    power = math.floor(math.log2(abs(total.numerator)) - math.log2(total.denominator)) - 52
    while abs(total) / Fraction(2) ** power >= 2 ** 53:
        power += 1
    while abs(total) / Fraction(2) ** power < 2 ** 52:
        power -= 1
    return math.ldexp(round(total / Fraction(2) ** power) / len(xs), power)


def test_means_are_sums_rounded_once(spark):
    rng = random.Random(7)
    rows = [(g, x) for g in range(70) for x in _values(rng, g % 7, rng.randint(1, 30))]
    rows += [(100, 1.7e308), (100, 1.7e308), (101, None), (102, 5e-324), (103, -2.5), (104, 1e20), (104, 1.0), (104, -1e20)]
    got = _means(spark.createDataFrame(rows, "g int, x double").repartition(3))
    for g in got:
        xs = [x for k, x in rows if k == g and x is not None and x == x and abs(x) != float("inf")]
        assert got[g] == _mean(xs), g
    assert got[104] == 1 / 3 and got[102] == 5e-324 and got[100] == 1.7e308  # whose sum is beyond doubles


def test_same_bits_under_twenty_partitionings(spark):
    rng = random.Random(8)
    rows = [(g, x) for g in range(14) for x in _values(rng, g % 7, 40)]
    df = spark.createDataFrame(rows, "g int, x double")
    first = _means(df)
    for k in range(20):
        assert _means(df.orderBy(F.rand(k)).repartition(1 + k % 5)) == first
