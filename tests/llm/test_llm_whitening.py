"""Whitening against plain double-precision linear algebra, and its eigenvectors against known ones."""

import math

import numpy as np
import pytest

from cabflow.llm import queries, whitening


def brute(rows, k=4, scale=256):
    usable = [(i, [math.floor(scale * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max(len(v) for _, v in usable)
    usable = [(i, tuple(v + [0] * (width - len(v)))) for i, v in usable]
    x = sorted({v for _, v in usable})
    n, total = len(x), [sum(v[j] for v in x) for j in range(width)]
    centred = np.array(x, float) - np.array(total) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for i, v in usable:
        w = (np.array(v, float) - np.array(total) / n) @ vectors / np.sqrt(values)
        out.append((i, n, sum((n * c - s) ** 2 for c, s in zip(v, total)), w[:k], values[:k] / values.sum()))
    return out


def run(spark, rows, k=4, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    model = whitening.fit(df, components=k, **kw)
    out, new = whitening.whiten(df, model, **kw)
    return model, [(r["vec_id"], r[new["deviation"]], r[new["whitened"]]) for r in out.collect()]


def test_against_plain_linear_algebra(spark):
    rng = np.random.default_rng(4)
    scale = np.linspace(1.5, 0.2, 12)
    rows = [(i, [float(c) for c in (rng.normal(3, 1, 12) * scale).astype(np.float32)]) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(200)]  # a third are one vector, which counts once
    rows += [(600, None), (601, [None] * 12), (602, [math.nan] * 12), (603, [math.inf] + [0.0] * 11), (None, rows[3][1]), (5, rows[9][1])]
    model, got = run(spark, rows)
    expected = brute(rows)
    assert model.n == 400 and model.identity_error < 1e-12
    flip = np.sign([a * b for a, b in zip(got[0][2], next(e for e in expected if e[0] == got[0][0])[3])])
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    mine = sorted(((i, d, np.array(w) * flip) for i, d, w in got), key=key)
    theirs = sorted(((i, d, w) for i, _, d, w, _ in expected), key=key)
    assert [r[:2] for r in mine] == [r[:2] for r in theirs]
    assert max(np.abs(a[2] - b[2]).max() for a, b in zip(mine, theirs)) < 1e-9
    assert np.allclose(model.explained, expected[0][4], rtol=1e-9)


def known(values, seed=0):
    """A symmetric matrix with these eigenvalues, and its eigenvectors, to more than double precision."""
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(d, dtype=np.longdouble) - 0.5 * (q.T @ q))
    a = (q * np.asarray(values, np.longdouble)) @ q.T
    return (a + a.T) / 2, q


def test_refined_far_beyond_float32_and_clusters_are_told_apart():
    a, q = known(np.linspace(100, 1, 40))
    values, x = whitening.eigenpairs(a)
    assert np.allclose(values, np.linspace(100, 1, 40), rtol=1e-15)
    assert float(np.abs(np.abs(q.T @ x) - np.eye(40)).max()) < 1e-15
    close = np.linspace(100, 1, 40).astype(np.longdouble)
    close[1], close[2], close[11] = close[0] - np.longdouble("1e-8"), close[0] - np.longdouble("3e-8"), close[10] - np.longdouble("1e-6")
    a, q = known(close)
    _, x = whitening.eigenpairs(a)
    assert float(np.abs(np.abs(q.T @ x) - np.eye(40)).max()) < 1e-8  # rounding of the matrix over the gap
    assert np.abs(x.T @ x - np.eye(40)).max() < 1e-15
    plain = np.linalg.eigh(a.astype(float))[1][:, ::-1]
    assert float(np.abs(np.abs(q.T @ plain) - np.eye(40)).max()) > 1e-7  # a double-precision solver cannot


def test_equal_eigenvalues_and_zeros():
    for values in (np.ones(9), np.r_[5.0, np.zeros(8)], np.zeros(3)):
        a, _ = known(values)
        found, x = whitening.eigenpairs(a)
        assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-15
        assert np.abs(found - values).max() < 1e-15 and np.abs(a @ x - x * found).max() < 1e-15


def test_products_are_exact_at_any_size():
    rng = np.random.default_rng(1)
    for reach in (10, 2**24, 2**40, 2**52):
        x = rng.integers(-reach, reach, (50, 3))
        whole = x.astype(object)
        assert (whitening.products(whitening._less(x, [7, -3, 0])) == (whole - np.array([7, -3, 0], object)).T @ (whole - np.array([7, -3, 0], object))).all()


def test_far_from_zero_nothing_cancels(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(int(1e6) + int(v)) for v in rng.integers(0, 5, 3)]) for i in range(100)]
    model, got = run(spark, rows)
    assert model.identity_error < 1e-12 and len(got) == 100


def test_edges(spark):
    one = [(1, [0.5, 0.25]), (2, [0.5, 0.25])]
    model, got = run(spark, one)
    assert model.n == 1 and [(i, d, w) for i, d, w in got] == [(1, 0, []), (2, 0, [])]  # no variance, no component
    model, got = run(spark, [(1, None)])
    assert model.n == 0 and got == []
    assert run(spark, [])[1] == []
    model, got = run(spark, [(1, []), (2, [1.0]), (3, [1.0, 1.0])])  # shorter: filled up with 0
    assert model.n == 3 and len(got) == 3 and {len(w) for _, _, w in got} == {2}
    with pytest.raises(Exception, match="64 bits"):
        run(spark, [(1, [1e20]), (2, [0.0])])
    with pytest.raises(Exception, match="64 bits"):
        run(spark, [(i, [1e7 * i]) for i in range(40)])  # the scaled vectors fit, the deviation does not


def test_clashing_names_and_other_columns(spark):
    rows = [(i, [float(i % 7), float(i % 5)], "w", 1, 2) for i in range(35)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, whitened string, X int, deviation int")
    out, new = whitening.whiten(df, whitening.fit(df))
    assert out.columns[:5] == df.columns and len(set(new.values()) & set(df.columns)) == 0
    assert {r["whitened"] for r in out.collect()} == {"w"}


def test_query(spark):
    got = queries.op11_whitening(spark, "/root/testdata/sf0.001").collect()
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    expected = {i: (n, d, w, e) for i, n, d, w, e in brute(rows)}
    assert len(got) == 4 * len(expected)
    for r in got:
        n, d, w, e = expected[r["vec_id"]]
        assert (r["n"], r["deviation"]) == (n, d)
        assert abs(abs(r["whitened"]) - abs(w[r["component"] - 1])) < 1e-6
        assert abs(r["explained"] / e[r["component"] - 1] - 1) < 1e-9 and r["identity_error"] < 1e-10
