"""Parity rules on hand-written edge rows (minute boundaries, DST, 24 h, weekend, rounding, NULLs)."""

import math

from pyspark.sql import functions as F

from cabflow.functions.columns import is_weekend, minute_diff, sql_round
from cabflow.operators import indicators as ind
from cabflow.operators import quality as qual
from cabflow.operators import reshape as rs
from cabflow.operators.normalize import rejected_trips, valid_trips
from helpers import trips_frame, ts


def _dur(spark, p, d):
    df = trips_frame(spark, [{"pickup_datetime": ts(p), "dropoff_datetime": ts(d)}])
    return df.select(minute_diff("pickup_datetime", "dropoff_datetime").alias("m")).first().m


def test_minute_boundaries(spark):
    assert _dur(spark, "2024-01-01 10:00:59", "2024-01-01 10:02:00") == 2
    assert _dur(spark, "2024-01-01 10:00:59", "2024-01-01 09:59:10") == -1
    assert _dur(spark, "2024-12-31 23:59:59.9", "2025-01-01 00:00:00") == 1


def test_minute_diff_ignores_session_zone_and_dst(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert _dur(spark, "2024-03-10 02:30:30", "2024-03-10 03:10:05") == 40
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_valid_trip_rules(spark):
    rows = [
        {"pickup_datetime": ts("2024-05-01 08:00:00"), "dropoff_datetime": ts("2024-05-02 08:00:00")},  # exactly 24 h
        {"pickup_datetime": ts("2024-05-01 08:00:00"), "dropoff_datetime": ts("2024-05-02 08:00:01")},  # 24 h + 1 s
        {"pickup_datetime": ts("2024-05-01 08:00:00"), "dropoff_datetime": ts("2024-05-01 08:00:00")},  # zero length
        {"pickup_datetime": ts("2024-05-01 08:00:00"), "dropoff_datetime": ts("2024-05-01 08:10:00"), "trip_distance": 0.0},
        {"pickup_datetime": ts("2024-05-01 08:00:00"), "dropoff_datetime": ts("2024-05-01 08:10:00"), "trip_distance": None},
        {"pickup_datetime": ts("2024-12-31 23:59:59.9"), "dropoff_datetime": ts("2025-01-01 00:00:00")},  # year edge
        {"pickup_datetime": ts("2023-12-31 23:50:00"), "dropoff_datetime": ts("2024-01-01 00:10:00")},  # other year
    ]
    t = trips_frame(spark, rows)
    v = valid_trips(t).orderBy("pickup_datetime", "dropoff_datetime").collect()
    got = {(r.pickup_datetime, r.dropoff_datetime, r.trip_distance) for r in v}
    assert (ts("2024-05-01 08:00:00"), ts("2024-05-02 08:00:00"), 1.0) in got
    assert (ts("2024-05-01 08:00:00"), ts("2024-05-01 08:10:00"), 0.0) in got
    assert (ts("2024-12-31 23:59:59.9"), ts("2025-01-01 00:00:00"), 1.0) in got
    assert len(v) == 3
    rej = rejected_trips(t)
    assert rej.count() == len(rows) - 3
    assert rej.filter(F.size("reasons") == 0).count() == 0
    q = qual.quality(t).first()
    assert q.duration_over_24h == 1 and q.nonpositive_duration == 1 and q.nonpositive_distance == 1
    assert q.pickup_outside_file_year == 1


def test_weekend_numbering(spark):
    t = trips_frame(
        spark,
        [{"pickup_datetime": ts(d + " 12:00:00")} for d in ("2024-01-05", "2024-01-06", "2024-01-07", "2024-01-08")],
    )
    flags = [r.w for r in t.orderBy("pickup_datetime").select(is_weekend("pickup_datetime").alias("w")).collect()]
    assert flags == [False, True, True, False]


def test_rounding_is_half_away_from_zero_in_binary(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (0.125,)], "x double")
    got = [r.r for r in df.select(sql_round("x", 2).alias("r")).collect()]
    assert got == [1.0, 2.68, -1.0, 0.13]


def test_null_payment_is_own_group_and_tip_rule(spark):
    base = {"pickup_datetime": ts("2024-01-06 10:00:00"), "dropoff_datetime": ts("2024-01-06 10:20:00")}
    t = trips_frame(
        spark,
        [
            {**base, "payment_type": None},
            {**base, "payment_type": 1, "fare_amount": 10.0, "tip_amount": 2.0},
            {**base, "payment_type": 1, "fare_amount": 0.0, "tip_amount": 2.0},  # no fare: not in the tip mean
            {**base, "payment_type": 2},
        ],
    )
    v = valid_trips(t)
    mix = {r.payment_type: r.trips for r in ind.payment_mix(v).collect()}
    assert mix == {None: 1, 1: 2, 2: 1}
    y = ind.yearly_indicators(v).first()
    assert y.avg_card_tip_pct == 20.0 and y.weekend_share_pct == 100.0
    shares = [r.share_pct for r in ind.payment_share(v).collect()]
    assert abs(sum(shares) - 100.0) < 0.05


def test_ratio_is_null_without_green_year(spark):
    yearly = spark.createDataFrame(
        [(2024, "yellow", 40), (2024, "green", 10), (2025, "yellow", 30)], "file_year long, taxi_type string, trips long"
    )
    got = {r.file_year: r.ratio for r in rs.yellow_green_ratio(yearly).collect()}
    assert got == {2024: 4.0, 2025: None}


def test_amounts_are_not_rounded_before_they_are_summed(spark):
    from cabflow.operators import cube as cb
    from cabflow.operators import indicators as ind

    rows = [{"total_amount": 0.004, "trip_distance": 0.004, "pickup_datetime": ts("2024-01-05 10:00:00"), "dropoff_datetime": ts("2024-01-05 10:10:00")}] * 1000
    valid = valid_trips(trips_frame(spark, rows))
    for frame in (ind.totals(valid), cb.totals(cb.indicator_cube(valid))):
        r = frame.first()
        assert abs(r.revenue - 4.0) < 1e-9 and abs(r.avg_total - 0.004) < 1e-12 and abs(r.avg_distance - 0.004) < 1e-12


def test_a_nan_gives_a_nan_and_does_not_abort(spark):
    from cabflow.operators import indicators as ind

    trips = trips_frame(spark, [{"total_amount": float("nan")}, {"total_amount": 1.0}])
    assert math.isnan(ind.bench_summary(trips).first().avg_total)


def test_suffix_period_equals_whole_path_regex(spark):
    """The anchored 15-character suffix match returns what the unanchored whole-path regex returns."""
    import random

    from cabflow.functions.columns import FILE_PERIOD_ANCHORED, FILE_PERIOD_LENGTH, FILE_PERIOD_PATTERN

    rng = random.Random(11)
    tokens = ["2024", "-", "01", "1", ".parquet", "/", "yellow_tripdata_", "9", "x", "12-", ".parq", "2025-13"]
    names = ["", "2024-01.parquet", "a2024-01.parquet", "024-01.parquet", "/2024-01.parquet", "2024-01.parquet.x"]
    names += ["".join(rng.choice(tokens) for _ in range(rng.randint(1, 9))) for _ in range(2000)]
    names += [
        "".join(rng.choice(tokens) for _ in range(rng.randint(0, 5)))
        + f"{rng.randint(0, 9999):0{rng.choice([3, 4, 4, 5])}d}-{rng.randint(0, 99):0{rng.choice([1, 2, 2])}d}.parquet"
        + rng.choice(["", "", "", "x", "/", ".parquet"])
        for _ in range(2000)
    ]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    suffix = F.substring("p", -FILE_PERIOD_LENGTH, FILE_PERIOD_LENGTH)
    got = df.select(
        *[F.regexp_extract("p", FILE_PERIOD_PATTERN, k).alias(f"a{k}") for k in (1, 2)],
        *[F.regexp_extract(suffix, FILE_PERIOD_ANCHORED, k).alias(f"b{k}") for k in (1, 2)],
    )
    assert got.filter((F.col("a1") != F.col("b1")) | (F.col("a2") != F.col("b2"))).count() == 0
    assert got.filter(F.col("a1") != "").count() > 500  # the generator does produce matches
