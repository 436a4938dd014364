"""Exact top-k by inner product, with candidates eliminated by distances to many pivots.

Vectors are put on a sphere by one more coordinate, so that a larger inner
product with a query is a smaller distance to it. Distances of all vectors to
the pivots are computed once and stored. By the triangle inequality, the largest
difference between a query's and a candidate's distance to a pivot is a lower
bound on their distance, which gives an upper bound on their score. A query takes
its candidates in bound order and stops when no bound reaches its k-th score;
candidates whose bound equals that score are still evaluated, so ties are exact.

Queries stand in blocks of ``QUERY_BYTES``, and each block meets all candidates in
some slices: a task holds one block and streams a slice of the candidates past it,
batch by batch, with each query's best k so far. A candidate is shuffled once for
each query block, that is once where the queries fit in one block, and a query once
for each slice, of which there are no more than keep all tasks busy. Only the
pivots (``n_pivots`` vectors chosen from ``PIVOT_SAMPLE``) reach the driver.

Scores are exact: products are computed in doubles where these hold every sum, else
in whole numbers; a score beyond 64 bits raises, and so does a scaled component.

Defined results: vectors that are null, or hold null or non-finite components, take
no part; every other row is a candidate for every query but its own row, rows that
share an id or have none as well (no id comes last among ties); shorter vectors count
as filled up with 0, so very long ones set the width; a query with fewer candidates
gets them all; an empty table gives no rows; other columns and their names are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.llm.common import shuffle_partitions, stored, unstore
from cabflow.llm.whitening import scaled, whole_matrix

PIVOT_SAMPLE = 2048
N_PIVOTS = 32
QUERY_BYTES = 32 << 20
SLICE_ROWS = 4096  # a slice has at least so many candidates
FIRST_LOOK = 64


def choose_pivots(sample: np.ndarray, n_pivots: int) -> np.ndarray:
    """Vectors of the sample far from each other: each is the farthest from all before it."""
    if not len(sample):
        return sample
    chosen = [int(np.argmax((sample**2).sum(1)))]
    nearest = ((sample - sample[chosen[0]]) ** 2).sum(1)
    while len(chosen) < min(n_pivots, len(sample)):
        chosen.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def lifted(x: np.ndarray, radius2: float) -> np.ndarray:
    """Vectors with the coordinate that puts them on the sphere of all vectors."""
    return np.hstack([x, np.sqrt(np.maximum(0.0, radius2 - (x**2).sum(1)))[:, None]])


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * x @ pivots.T
    return np.sqrt(np.maximum(0.0, square))


def _reach(x: np.ndarray) -> int:
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


class Search:
    """The best k candidates so far of each query of a block."""

    def __init__(self, queries: np.ndarray, rows: np.ndarray, far: np.ndarray, radius2: float, k: int) -> None:
        self.whole, self.rows, self.far, self.radius2, self.k = queries, rows, far, radius2, k
        self.plain = queries.astype(np.float64)
        self.square = (self.plain**2).sum(1)
        none = np.zeros(0, np.int64)
        self.best = [(none, none.astype(bool), none) for _ in range(len(queries))]  # ids, whether there is none, scores

    def scores(self, n: int, candidates: np.ndarray) -> np.ndarray:
        """Exact products of a query with candidates, which come as doubles where these hold every sum."""
        if candidates.dtype == np.float64:
            return (candidates @ self.plain[n]).astype(np.int64)
        if _reach(candidates) * _reach(self.whole[n]) * candidates.shape[1] < 2**63:
            return candidates @ self.whole[n]
        exact = candidates.astype(object) @ self.whole[n].astype(object)
        if any(not -(2**63) <= s < 2**63 for s in exact):
            raise OverflowError("a score leaves 64 bits")
        return exact.astype(np.int64)

    def _merged(self, n: int, ids: np.ndarray, absent: np.ndarray, scores: np.ndarray) -> None:
        a, b, c = (np.concatenate(x) for x in zip(self.best[n], (ids, absent, scores), strict=True))
        order = np.lexsort((a, b, ~c))[: self.k]  # ~ turns the order around without overflow
        self.best[n] = (a[order], b[order], c[order])

    def take(self, candidates: np.ndarray, ids: np.ndarray, absent: np.ndarray, rows: np.ndarray, far: np.ndarray) -> None:
        """Let the block's queries meet some more candidates, each with its distances to the pivots."""
        exact = _reach(candidates) * _reach(self.whole) * candidates.shape[1] < 2**53
        candidates = candidates.astype(np.float64) if exact else candidates
        columns = np.ascontiguousarray(far.T)
        gap, nearest = np.empty(len(ids)), np.empty(len(ids))
        for n in range(len(self.whole)):
            nearest[:] = 0  # the largest lower bound on the distance over all pivots
            for p, column in enumerate(columns):
                np.subtract(column, self.far[n, p], out=gap)
                np.abs(gap, out=gap)
                np.maximum(nearest, gap, out=nearest)
            bound = (self.square[n] + self.radius2 - nearest * nearest) / 2
            bound += 1e-6 * (1 + self.radius2)  # rounding of the distances
            bound[rows == self.rows[n]] = -np.inf
            step = FIRST_LOOK
            rest = np.flatnonzero(bound >= self._worst(n))
            first = rest[np.argpartition(-bound[rest], step)[:step]] if len(rest) > step else rest
            first = first[np.isfinite(bound[first])]
            seen = np.zeros(len(ids), bool)
            seen[first] = True
            self._look(n, first, candidates, ids, absent)
            rest = rest[(bound[rest] >= self._worst(n)) & ~seen[rest] & np.isfinite(bound[rest])]
            rest = rest[np.argsort(-bound[rest], kind="stable")]
            while len(rest):
                step *= 4
                some, rest = rest[:step], rest[step:]
                self._look(n, some, candidates, ids, absent)
                rest = rest[: int(np.searchsorted(-bound[rest], -self._worst(n), "right"))]

    def _worst(self, n: int) -> float:
        scores = self.best[n][2]
        return float(scores[-1]) if len(scores) == self.k else -np.inf

    def _look(self, n: int, some: np.ndarray, candidates: np.ndarray, ids: np.ndarray, absent: np.ndarray) -> None:
        if len(some):
            own = self.scores(n, candidates.take(some, axis=0))
            if len(self.best[n][2]) == self.k:
                better = own >= self.best[n][2][-1]
                some, own = some[better], own[better]
            self._merged(n, ids[some], absent[some], own)


def top_k(
    df: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    scale: float = 256.0,
    n_pivots: int = N_PIVOTS,
    query_bytes: int = QUERY_BYTES,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score) for each row where ``is_query`` (an expression over ``vec_id``) holds."""
    spark = df.sparkSession
    whole = df.select(F.col(f"`{key}`").cast("long").alias("vec_id"), scaled(F.col(f"`{vector}`"), scale).alias("v"))
    whole = whole.filter(F.col("v").isNotNull()).withColumn("asks", F.coalesce(is_query, F.lit(False)))
    rows = stored(whole.withColumn("row", F.monotonically_increasing_id()), "topk-vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    stats = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("asks").alias("queries"),
        F.max(square).alias("radius2"),
        F.max(F.size("v")).alias("width"),
    ).first()
    result = "query_id long, rank int, vec_id long, score long"
    if not stats["n"] or not stats["queries"]:
        unstore(rows)
        return spark.createDataFrame([], result)
    width, radius2 = max(1, stats["width"]), float(stats["radius2"])
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(PIVOT_SAMPLE).select("v").toArrow()["v"].combine_chunks()
    pivots = choose_pivots(lifted(whole_matrix(sample, width).astype(np.float64), radius2), n_pivots)

    far = T.ArrayType(T.DoubleType())
    fields = [*rows.schema.fields, T.StructField("far", far), T.StructField("query_far", far)]
    indexed = stored(rows.mapInArrow(_index(pivots, width, radius2), T.StructType(fields)), "topk-pivot-table")
    unstore(rows)
    blocks = math.ceil(stats["queries"] * 8 * (width + len(pivots) + 2) / query_bytes)
    parts = shuffle_partitions(spark)
    slices = min(math.ceil(stats["n"] / slice_rows), math.ceil(4 * parts / blocks))

    def copies(n: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias(name)

    def one_of(n: int, seed: int, name: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(n)).alias(name)

    candidates = indexed.select("vec_id", "row", "v", "far", F.lit(True).alias("met"), one_of(slices, 1, "b"), copies(blocks, "q"))
    asking = indexed.filter("asks").select(
        "vec_id", "row", "v", F.col("query_far").alias("far"), F.lit(False).alias("met"), copies(slices, "b"), one_of(blocks, 2, "q")
    )
    # A task gets the queries of a block first, then the candidates of a slice.
    dealt = candidates.unionByName(asking).repartition(parts, "q", "b").sortWithinPartitions("q", "b", "met")
    found = dealt.mapInArrow(_stream(width, radius2, k), "query_id long, query_row long, vec_id long, score long")
    place = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _index(pivots: np.ndarray, width: int, radius2: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = whole_matrix(batch.column(batch.schema.get_field_index("v")), width).astype(np.float64)
            asks = batch.column(batch.schema.get_field_index("asks")).to_pylist()
            far = distances(lifted(x, radius2), pivots)
            own = distances(np.hstack([x, np.zeros((len(x), 1))]), pivots)  # a query's added coordinate is 0
            columns = [
                *batch.columns,
                pa.array(list(far), pa.list_(pa.float64())),
                pa.array([own[i] if m else None for i, m in enumerate(asks)], pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "far", "query_far"])

    return run


def _stream(width: int, radius2: float, k: int):
    def found(search: Search, ids: list[int]) -> pa.RecordBatch:
        sizes = [len(b[0]) for b in search.best]
        vec, absent, scores = (np.concatenate([b[i] for b in search.best]) for i in range(3))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array(ids, np.int64), sizes)), pa.array(np.repeat(search.rows, sizes)),
                pa.array(vec, pa.int64(), mask=absent), pa.array(scores, pa.int64()),
            ],
            names=["query_id", "query_row", "vec_id", "score"],
        )

    def columns(part: pa.Table) -> tuple:
        far = part["far"].combine_chunks()
        far = far.flatten().to_numpy(zero_copy_only=False).reshape(len(far), -1)
        return whole_matrix(part["v"].combine_chunks(), width), part["row"].to_numpy(), far

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, search, ids = None, [], None, []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            marks = np.stack([table["q"].to_numpy(), table["b"].to_numpy(), table["met"].to_numpy(zero_copy_only=False)], 1)
            cuts = np.flatnonzero((np.diff(marks, axis=0) != 0).any(1)) + 1
            for start, end in zip(np.r_[0, cuts], np.r_[cuts, len(marks)], strict=True):
                if end == start:
                    continue
                part, (q, b, met) = table.slice(start, end - start), marks[start]
                if (q, b) != place:
                    if search is not None:
                        yield found(search, ids)
                    place, held, search = (q, b), [], None
                if not met:
                    held.append(part)
                    continue
                if search is None and held:  # a block may have no query, as it is dealt by hash
                    asking = pa.concat_tables(held)
                    x, rows, far = columns(asking)
                    search, ids, held = Search(x, rows, far, radius2, k), asking["vec_id"].to_pylist(), []
                if search is not None:
                    x, rows, far = columns(part)
                    some = part["vec_id"].combine_chunks()
                    absent = some.is_null().to_numpy(zero_copy_only=False)
                    search.take(x, some.fill_null(0).to_numpy(zero_copy_only=False), absent, rows, far)
        if search is not None:
            yield found(search, ids)

    return run
