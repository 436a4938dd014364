"""Exact top-k against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabflow.llm import topk


def brute(rows, k=5, step=50):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, own) in enumerate(usable):
        if q is None or q % step:
            continue
        scored = sorted((-sum(a * b for a, b in zip(own, v)), i is None, i or 0) for n, (i, v) in enumerate(usable) if n != at)
        out += [(q, n + 1, None if absent else i, -s) for n, (s, absent, i) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def run(spark, rows, step=50, kind="float", **limits):
    df = spark.createDataFrame([(*r[:2], "x") for r in rows], f"vec_id long, embedding array<{kind}>, score string")
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % step == 0, **limits).collect()), key=repr)


def test_random_vectors_ties_and_copies(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 16).astype(np.float32)]) for i in range(600)]
    rows += [(600 + i, rows[100][1]) for i in range(300)]  # a third are one vector
    rows += [(900 + i, [0.5] + [0.0] * 15) for i in range(50)]
    for limits in ({"query_bytes": 1000, "slice_rows": 64, "n_pivots": 8}, {}, {"slice_rows": 16}):
        assert run(spark, rows, **limits) == brute(rows)


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5]), (2, None), (3, [1.0, None]), (4, [1.0, math.nan]), (5, [math.inf, 1.0]), (None, [1.0, 1.0]), (None, [9.0, 9.0]),
            (6, [-1.0, 0.25]), (6, [-1.0, 0.25]), (7, [3.0, 0.0]), (7, [-3.0, 0.0]), (8, []), (0, [1.0, 2.0]), (50, [0.0, 0.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:1]) == []  # no candidate
    assert run(spark, rows[1:2]) == []  # no query
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") % 50 == 0).isEmpty()


def test_every_row_that_shares_an_id_counts(spark):
    rows = [(i // 3, [float(i % 7), float(i % 5), 1.0]) for i in range(300)]
    assert run(spark, rows) == brute(rows)


def test_large_components_are_exact(spark):
    """Scaled components beyond 2**31 and scores beyond 2**53, where doubles would be off."""
    rng = np.random.default_rng(7)
    near = 2.0**22  # components of some 2**30: sums of products have more digits than a double
    rows = [(i, [float(near + int(v)) for v in rng.integers(-40, 40, 4)]) for i in range(120)]
    rows += [(200, [2.0e7, 1.0, 0.0, -3.0]), (201, [0.0, 2.0e7, 5.0, 1.0]), (250, [0.5, 0.25, -2.0e7, 3.0])]
    assert run(spark, rows, kind="double") == brute(rows)
    huge = [(0, [float(2**31 - 1) / 256] * 4), (1, [float(2**31 - 1) / 256] * 4), (2, [1.0] * 4)]
    with pytest.raises(Exception, match="64 bits"):  # 4 * (2**31 - 1)**2 is no long
        run(spark, huge, kind="double")
    with pytest.raises(Exception, match="64 bits"):
        run(spark, [(0, [1e30]), (1, [1.0])], kind="double")


def test_a_candidate_is_shuffled_once_where_the_queries_fit_in_a_block(spark):
    rows = [(i, [float(i % 11), float(i % 3)], "x") for i in range(2000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    made = []
    real = type(df).repartition

    def counted(self, n, *cols):
        made.append(self.count())
        return real(self, n, *cols)

    type(df).repartition = counted
    try:
        out = topk.top_k(df, F.col("vec_id") % 50 == 0, slice_rows=500)
        out.count()
    finally:
        type(df).repartition = real
    assert made == [2000 + 40 * 4]  # every candidate once, every query once a slice


def test_bounds_never_cut_a_better_candidate():
    rng = random.Random(8)
    gen = np.random.default_rng(8)
    for _ in range(40):
        n, width = rng.randint(1, 300), rng.randint(1, 6)
        x = np.floor(gen.normal(0, 300, (n, width))).astype(np.int64)
        plain = x.astype(float)
        radius2 = float((plain**2).sum(1).max())
        pivots = topk.choose_pivots(topk.lifted(plain[:50], radius2), 5)
        far = topk.distances(topk.lifted(plain, radius2), pivots)
        own = topk.distances(np.hstack([plain, np.zeros((n, 1))]), pivots)
        rows, none = np.arange(n), np.zeros(n, bool)
        search = topk.Search(x[:3], rows[:3], own[:3], radius2, 4)
        for at in range(0, n, 70):
            part = slice(at, at + 70)
            search.take(x[part], rows[part], none[part], rows[part], far[part])
        for q in range(min(3, n)):
            scored = sorted((-int(s), i) for i, s in enumerate(x @ x[q]) if i != q)[:4]
            assert list(zip((-search.best[q][2]).tolist(), search.best[q][0].tolist())) == scored
