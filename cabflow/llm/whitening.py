"""Whitening of embeddings: eigenvectors in float32, refined in higher precision by matrix products.

Components are scaled to whole numbers, ``x = floor(scale * c)``, and each distinct vector counts
once in the fit. Two passes over the distinct vectors, both by Spark, give exact whole-number
moments: sums of the components, then products of the components less their rounded means.
Tasks add up their rows, Spark adds up the tasks by matrix entry, and the driver gets one number
an entry (``width`` squared, whatever the number of rows). So the covariance is the exact
fraction, rounded once.

Its eigenvectors come from a float32 solver and are corrected by the iteration of Ogita and
Aishima: with ``R = I - X'X`` and ``S = X'AX`` the correction of X is ``X E``, where E is half of R
and an antisymmetric part, S plus the mean eigenvalue times R over the eigenvalues' gap (written so,
rounding over a small gap turns X but cannot skew it); each step squares the error. Products are
in ``numpy.longdouble`` (a significand of 64 bits or more; elsewhere ``eigenpairs`` raises).
Eigenvalues that stand too close to be told apart at a step's accuracy form a cluster: its columns
are turned by the solution of the small problem ``X'(A - mu I)X``, whose scale is that of the
cluster's own gaps, and the iteration goes on.

Defined results: rows whose vector is null, or holds null or non-finite components, are left out;
null and repeated keys, extra columns and their names stay as they are (new columns get a name
that is not taken); shorter vectors count as filled up with 0, longer ones than those of the fit
raise; scaled components beyond 64 bits raise, and so does a deviation beyond 64 bits; components
without variance (eigenvalues of rounding size) are left out, so a table with a single distinct
vector, and an empty one, has none. Eigenvectors have their largest entry positive. Eigenvectors
of equal eigenvalues are any orthonormal set of their space. Very long vectors cost the driver
``width`` cubed steps a product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.llm.common import append, fresh_name, plus, stored, unstore

MARGIN = 16  # gaps up to so many times a step's accuracy count as clustered
EXACT = 2**53  # whole numbers below it are exact in a double
_MOMENT = "i int, j int, value decimal(38,0)"


@dataclass(frozen=True)
class Whitening:
    """``n`` vectors with sums ``centre * n + rest``; eigenvalues falling, one eigenvector a column."""

    n: int
    centre: list[int]
    rest: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def width(self) -> int:
        return len(self.centre)

    @property
    def explained(self) -> list[float]:
        return [float(v) / self.trace for v in self.values]


def scaled(vector: Column, scale: float) -> Column:
    """Whole-number components, null where the vector is null or holds null or non-finite components."""
    v = vector.cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    far = F.raise_error(F.lit("a scaled component leaves 64 bits")).cast("long")
    whole = F.transform(v, lambda c: F.when(F.abs(c * scale) < float(2**63), F.floor(c * scale)).otherwise(far))
    return F.when(v.isNotNull() & F.coalesce(finite, F.lit(False)), whole)


def whole_matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as whole numbers, filled up with 0."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    if len(sizes) and sizes.max() > width:
        raise ValueError(f"a vector has {sizes.max()} components, those of the fit {width}")
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _reach(x: np.ndarray) -> int:
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def _less(x: np.ndarray, centre: list[int]) -> np.ndarray:
    """``x - centre``: doubles where they hold it exactly, else Python's whole numbers."""
    if _reach(x) + max(map(abs, centre), default=0) < EXACT:
        return (x - np.array(centre, np.int64)).astype(np.float64)
    return x.astype(object) - np.array(centre, object)


def products(z: np.ndarray) -> np.ndarray:
    """``z'z``, exact: blocks of rows whose sums a double holds, added up as Python's whole numbers."""
    total = np.zeros((z.shape[1], z.shape[1]), object)
    if z.dtype == object:
        return total + z.T @ z if len(z) else total
    rows = int(EXACT // max(1, int(np.abs(z).max(initial=0)) ** 2))
    if not rows:
        return products(z.astype(np.int64).astype(object))
    for at in range(0, len(z), rows):
        block = z[at : at + rows]
        total += (block.T @ block).astype(np.int64).astype(object)
    return total


def _moments(width: int, centre: list[int] | None):
    """A task's rows: entries (i, j) of ``z'z``; without a centre (i, -1) with the sums and (-1, -1) with the count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width if centre is None else (width, width), object)
        for batch in batches:
            x = whole_matrix(batch.column(0), width)
            n += len(x)
            if centre is not None:
                total += products(_less(x, centre))
            elif _reach(x) * max(1, len(x)) < 2**63:
                total += x.sum(0).astype(object)
            else:
                total += x.astype(object).sum(0)
        if not n:
            return
        if centre is None:
            i, j, values = [-1, *range(width)], [-1] * (width + 1), [n, *total]
        else:
            up, left = np.triu_indices(width)
            i, j, values = up.tolist(), left.tolist(), total[up, left].tolist()
        decimals = pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), decimals], names=["i", "j", "value"])

    return run


def _summed(fit: DataFrame, width: int, centre: list[int] | None) -> dict[tuple[int, int], int]:
    entries = fit.mapInArrow(_moments(width, centre), _MOMENT).groupBy("i", "j").agg(F.sum("value").alias("value"))
    return {(r["i"], r["j"]): int(r["value"]) for r in entries.collect()}  # width squared numbers at most


def _clusters(values: np.ndarray, spread: float) -> list[np.ndarray]:
    """Positions of eigenvalues that stand within ``spread`` of the next one."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > spread) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def eigenpairs(a: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix, to double precision."""
    if np.finfo(np.longdouble).nmant < 63:
        raise NotImplementedError("numpy.longdouble is no wider than a double on this platform")
    a = np.asarray(a, np.longdouble)
    size = np.abs(a).max(initial=0)
    if not size:
        return np.zeros(len(a)), np.eye(len(a))
    a, one = a / size, np.eye(len(a), dtype=np.longdouble)
    norm = lambda m: np.sqrt((m * m).sum())
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    last, stalled = np.inf, 0
    for _ in range(rounds):
        r, s = one - x.T @ x, x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        spread = 2 * (norm(s - np.diag(values)) + norm(a) * norm(r))
        gap = values[None, :] - values[:, None]
        near = np.abs(gap) <= MARGIN * spread
        turn = (s + s.T + (values[None, :] + values[:, None]) * r) / np.where(near, 1, 2 * gap)  # antisymmetric
        x = x + x @ (r / 2 + np.where(near, 0, turn))
        stalled = stalled + 1 if spread > last / 4 else 0
        if stalled == 2:
            break
        last = min(spread, last)
        for cluster in _clusters(values, MARGIN * spread):
            own = x[:, cluster]
            small = own.T @ (a @ own - values[cluster].mean() * own)
            small = (small + small.T) / 2
            high = np.abs(small).max()
            if high:
                x[:, cluster] = own @ np.linalg.eigh((small / high).astype(np.float64))[1].astype(np.longdouble)
    x = x / np.sqrt((x * x).sum(0))
    values = (x * (a @ x)).sum(0) * size
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    x = x * np.where(x[np.abs(x).argmax(0), np.arange(len(a))] < 0, -1, 1)
    return values[order].astype(np.float64), x.astype(np.float64)


def _projected(z: np.ndarray, model: Whitening) -> np.ndarray:
    centred = z.astype(np.float64) - np.array([r / model.n for r in model.rest])
    return centred @ (model.vectors / np.sqrt(model.values))


def _spread(z: np.ndarray, model: Whitening) -> np.ndarray:
    """Sum over components of ``(n * x - S)`` squared: 64-bit arithmetic, whose wraps cancel where the sum fits."""
    about = ((model.n * z.astype(np.float64) - np.array(model.rest, np.float64)) ** 2).sum(1)
    for row in z[about >= 2.0**63 * (1 - 1e-9)]:
        if sum((model.n * int(v) - r) ** 2 for v, r in zip(row, model.rest, strict=True)) >= 2**63:
            raise OverflowError("a deviation leaves 64 bits")
    wrapped = lambda v: ((v + 2**63) % 2**64 - 2**63).astype(np.int64)
    whole = wrapped(z) if z.dtype == object else z.astype(np.int64)
    with np.errstate(over="ignore"):
        far = whole * np.int64(model.n) - wrapped(np.array(model.rest, object))
        return (far * far).sum(1)


def _check(model: Whitening):
    """A task's sums of whitened components and of their products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, seen = len(model.values), False
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = _projected(_less(whole_matrix(batch.column(0), model.width), model.centre), model)
            total += np.vstack([w.sum(0), w.T @ w])
            seen = seen or len(w) > 0
        if seen:
            i, j = np.indices(total.shape)
            columns = [pa.array(c.ravel(), t) for c, t in ((i, pa.int32()), (j, pa.int32()), (total, pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "value"])

    return run


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit's covariance less the identity."""
    k = len(model.values)
    if not k:
        return 0.0
    sums = np.zeros((k + 1, k))
    entries = fit.mapInArrow(_check(model), "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    for r in entries.collect():  # k * (k + 1) numbers
        sums[r["i"], r["j"]] = r["value"]
    mean = sums[0] / model.n  # of rounding size, as the components are centred before they are multiplied
    return float(np.abs(sums[1:] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def fit(df: DataFrame, vector: str = "embedding", scale: float = 256.0, components: int | None = None) -> Whitening:
    """The whitening of the distinct scaled vectors of ``df``: its first ``components`` (None: all)."""
    x = scaled(F.col(f"`{vector}`"), scale).alias("x")
    distinct = stored(df.select(x).filter(F.col("x").isNotNull()).distinct(), "whitening-fit")
    try:
        width = distinct.agg(F.max(F.size("x"))).first()[0] or 0
        sums = _summed(distinct, width, None)
        n = sums.get((-1, -1), 0)
        total = [sums.get((i, -1), 0) for i in range(width)]
        if not n or not width:
            return Whitening(n, total, [0] * width, np.zeros(0), np.zeros((width, 0)), 0.0, 0.0)
        centre = [(2 * s + n) // (2 * n) for s in total]  # the mean, rounded
        rest = [s - n * c for s, c in zip(total, centre, strict=True)]
        entries = _summed(distinct, width, centre)
        exact = [[n * entries[min(i, j), max(i, j)] - rest[i] * rest[j] for j in range(width)] for i in range(width)]
        covariance = np.array([[np.longdouble(v) for v in row] for row in exact]) / np.longdouble(n) / np.longdouble(n)
        values, vectors = eigenpairs(covariance)
        trace = float(sum(exact[i][i] for i in range(width)) / n**2)
        kept = int((values > width * 2.0**-52 * max(values[0], 0)).sum()) if values[0] > 0 else 0
        kept = min(kept, width if components is None else components)
        model = Whitening(n, centre, rest, values[:kept], vectors[:, :kept], trace, math.nan)
        return Whitening(n, centre, rest, model.values, model.vectors, trace, _identity_error(distinct, model))
    finally:
        unstore(distinct)


def whiten(
    df: DataFrame, model: Whitening, vector: str = "embedding", scale: float = 256.0
) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with each row's whitened components and deviation; the dict has the new columns' names."""
    x = fresh_name(df.columns, "x")
    names = {n: fresh_name([*df.columns, x], n) for n in ("whitened", "deviation")}
    rows = df.withColumn(x, scaled(F.col(f"`{vector}`"), scale)).filter(F.col(x).isNotNull())
    schema = plus(
        rows.schema,
        T.StructField(names["whitened"], T.ArrayType(T.DoubleType())),
        T.StructField(names["deviation"], T.LongType()),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = _less(whole_matrix(batch.column(batch.num_columns - 1), model.width), model.centre)
            w = _projected(z, model)
            offsets = pa.array(np.arange(len(z) + 1, dtype=np.int32) * w.shape[1])
            lists = pa.ListArray.from_arrays(offsets, pa.array(w.ravel()))
            yield append(batch, list(names.values()), [lists, pa.array(_spread(z, model))])

    return rows.mapInArrow(run, schema).drop(x), names
