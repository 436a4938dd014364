"""Spark re-expressions of the parity rules vs plain Python on random inputs."""

import math
import random
from datetime import datetime, timedelta

from cabflow.functions.columns import is_weekend, minute_diff, sql_round


def test_minute_boundaries(spark):
    rng = random.Random(5)
    base = datetime(2023, 12, 25)
    rows = []
    for _ in range(3000):
        p = base + timedelta(seconds=rng.randint(0, 400 * 86400), microseconds=rng.choice([0, 1, 999999, rng.randint(0, 999999)]))
        d = p + timedelta(seconds=rng.randint(-7200, 3 * 86400), microseconds=rng.randint(0, 999999))
        rows.append((p, d))
    df = spark.createDataFrame(rows, "p timestamp_ntz, d timestamp_ntz")
    minute = lambda t: t.replace(second=0, microsecond=0)
    for r in df.select("p", "d", minute_diff("p", "d").alias("m")).collect():
        assert r.m == (minute(r.d) - minute(r.p)) // timedelta(minutes=1)


def test_weekend(spark):
    days = [(datetime(2024, 1, 1) + timedelta(days=i, hours=i % 24),) for i in range(400)]
    for r in spark.createDataFrame(days, "ts timestamp_ntz").select("ts", is_weekend("ts").alias("w")).collect():
        assert r.w == (r.ts.weekday() >= 5)


def test_rounding_is_half_away_from_zero_of_the_scaled_double(spark):
    rng = random.Random(9)
    values = [round(rng.uniform(-500, 500), rng.choice([2, 3, 4])) for _ in range(3000)]
    for r in spark.createDataFrame([(v,) for v in values], "x double").select("x", sql_round("x").alias("r")).collect():
        scaled = abs(r.x) * 100
        whole = math.floor(scaled) + (scaled - math.floor(scaled) >= 0.5)
        assert r.r == math.copysign(whole / 100, r.x)
    fixed = {1.005: 1.0, 2.675: 2.68, -0.125: -0.13, 0.005: 0.01, 2.5: 2.5, -7.0: -7.0}
    for r in spark.createDataFrame([(v,) for v in fixed], "x double").select("x", sql_round("x").alias("r")).collect():
        assert r.r == fixed[r.x], r
