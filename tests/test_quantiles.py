"""Exact distributed quantiles against brute force, with one group holding most rows."""

import math

import numpy as np

from cabflow.operators.quantiles import exact_quantiles


def test_matches_numpy_linear_with_hot_group(spark):
    rng = np.random.default_rng(7)
    rows = []
    for g, n in (("hot", 6000), ("cold", 300), ("tiny", 1)):
        vals = np.round(rng.gamma(2.0, 3.0, n), 2)
        rows += [(g, float(v)) for v in vals]
    rows += [("hot", None)] * 50  # NULLs are ignored
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.5, 0.9, 0.99, 1.0]
    got = {(r.g, r.prob): r.value for r in exact_quantiles(df, ["g"], "v", probs, slice_values=40).collect()}
    for g in ("hot", "cold", "tiny"):
        vals = np.array([v for k, v in rows if k == g and v is not None])
        for p in probs:
            want = float(np.quantile(vals, p, method="linear"))
            assert math.isclose(got[(g, p)], want, rel_tol=1e-12, abs_tol=1e-12), (g, p)


def test_any_slicing_equals_builtin_percentile(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(3)
    rows = [("hot" if i % 3 else "cold", float(np.round(rng.lognormal(2, 1), 2))) for i in range(5000)]
    rows += [("dups", v) for v in (0.1, 0.1, 0.1, 0.3, 0.3, 0.7, 0.7, 0.7, 0.7)]  # equal neighbours
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.25, 0.33, 0.5, 0.77, 0.9, 0.99]
    builtin = df.groupBy("g").agg(F.percentile("v", probs).alias("q")).collect()
    want = {(r.g, p): r.q[i] for r in builtin for i, p in enumerate(probs)}
    for kwargs in ({}, {"slice_values": 100}):
        got = {(r.g, r.prob): r.value for r in exact_quantiles(df, ["g"], "v", probs, **kwargs).collect()}
        assert got == want, kwargs


def test_monotone_and_duplicates(spark):
    rows = [("a", 5.0)] * 1000 + [("a", 1.0)] * 10 + [("a", 9.0)] * 10
    df = spark.createDataFrame(rows, "g string, v double")
    got = sorted((r.prob, r.value) for r in exact_quantiles(df, ["g"], "v", [0.005, 0.5, 0.995]).collect())
    assert [v for _, v in got] == [1.0, 5.0, 9.0]


def test_slicing_does_not_change_trip_measures_and_mean_is_plain(spark):
    from pyspark.sql import functions as F

    from cabflow.operators.normalize import valid_trips
    from cabflow.operators.quantiles import _stacked
    from cabflow.sources.fixture import fixture_trips

    stacked = _stacked(valid_trips(fixture_trips(spark, "/root/testdata/sf0.01")))
    probs, keys = [0.01, 0.5, 0.9, 0.99], ["taxi_type", "measure"]
    want = stacked.groupBy(*keys).agg(F.percentile("value", probs).alias("q"), F.avg("value").alias("m")).collect()
    for size in (3000, 10**9):
        got = {(r.taxi_type, r.measure, r.prob): (r.value, r.mean) for r in exact_quantiles(stacked, keys, "value", probs, slice_values=size).collect()}
        assert len(got) == 2 * 3 * len(probs)
        for r in want:
            for i, p in enumerate(probs):
                value, mean = got[r.taxi_type, r.measure, p]
                assert value == r.q[i] and math.isclose(mean, r.m, rel_tol=1e-12)


def test_close_probabilities_keep_their_own_columns(spark):
    from cabflow.operators.normalize import valid_trips
    from cabflow.operators.quantiles import quantiles
    from cabflow.sources.fixture import fixture_trips

    q = quantiles(valid_trips(fixture_trips(spark, "/root/testdata/sf0.001")), (0.5, 0.995, 0.999))
    assert [c for c in q.columns if c.startswith("total")] == ["total_p50", "total_p99_5", "total_p99_9"]
    assert all(r.total_p50 < r.total_p99_5 <= r.total_p99_9 for r in q.collect())


def test_only_bins_that_hold_a_rank_are_sorted(spark, monkeypatch):
    """Of 60,000 distinct values a few hundred reach the window, and none of the rest is stored again."""
    from pyspark.sql import functions as F

    from cabflow.operators import quantiles as qn

    df = spark.range(60_000).select(F.lit("g").alias("g"), (F.col("id") / 16.0).alias("v"))
    sizes = []
    real = qn._sorted_values

    def watched(counts, wanted):
        out = real(counts, wanted)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(qn, "_sorted_values", watched)
    got = {r.prob: r.value for r in qn.exact_quantiles(df, ["g"], "v", [0.5, 0.99]).collect()}
    want = df.agg(F.percentile("v", [0.5, 0.99]).alias("q")).first().q
    assert [got[0.5], got[0.99]] == want and sizes[0] < 60_000 / 20
    sizes.clear()
    got = {r.prob: r.value for r in qn.exact_quantiles(df, ["g"], "v", [0.5, 0.99], slice_values=50).collect()}
    assert [got[0.5], got[0.99]] == want and sizes[0] <= 4 * 50  # large bins were cut


def test_groups_without_values_nulls_nan_and_infinities(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("none", None)] * 3 + [(None, 1.0), (None, 3.0)] + [("odd", v) for v in (nan, inf, -inf, 0.0, -0.0, 1e300, -1e-300, 5e-324)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r.g, r.prob): (r.value, r.mean) for r in exact_quantiles(df, ["g"], "v", [0.0, 0.5, 1.0]).collect()}
    assert got["none", 0.5] == (None, None)
    assert [got[None, p][0] for p in (0.0, 0.5, 1.0)] == [1.0, 2.0, 3.0]
    assert got["odd", 0.0][0] == -inf and math.isnan(got["odd", 1.0][0])
    assert exact_quantiles(df.limit(0), ["g"], "v", [0.5]).isEmpty()


def test_bins_never_fall_as_values_grow(spark):
    from pyspark.sql import functions as F

    from cabflow.operators.quantiles import value_bin

    rng = np.random.default_rng(5)
    v = np.r_[rng.normal(0, 1, 3000), 10.0 ** rng.uniform(-320, 308, 3000), -(10.0 ** rng.uniform(-320, 308, 3000)), 0.0, np.nextafter(1.0, 2), 1.0]
    v = np.sort(v[np.isfinite(v)])
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    bins = [r.b for r in df.select("v", value_bin(F.col("v")).alias("b")).orderBy("v").collect()]
    assert bins == sorted(bins)


def test_values_crowded_in_one_bin_are_cut_until_they_are_few(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(6)
    v = [float(x) for x in np.r_[10.0 ** rng.uniform(-12, -4, 3000), rng.normal(100, 1e-9, 3000)]]
    df = spark.createDataFrame([("g", x) for x in v], "g string, v double")
    probs = [0.01, 0.3, 0.77, 0.999]
    want = df.agg(F.percentile("v", probs).alias("q")).first().q
    got = {r.prob: r.value for r in exact_quantiles(df, ["g"], "v", probs, slice_values=20).collect()}
    assert [got[p] for p in probs] == want
