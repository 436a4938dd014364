"""Rows next to each other in a global order, without a global window.

The order, by a key and a tie, is cut at quantiles of a sample of both into buckets,
four for each shuffle partition, so that rows of one key fill many buckets where
their ties differ. Only what stands at each bucket's ends reaches the driver: its
first and last row, or its first and last two runs of equal rows. Rows that follow a
bucket (or come before it) are sent to that bucket as well, as edges. One shuffle by
bucket then brings every row together with its neighbours, and a task streams its
buckets in order.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.llm.common import plus, sampled, shuffle_partitions

BUCKETS_PER_PARTITION = 4
SAMPLE_PER_BUCKET = 20
BUCKET, EDGE = "_bucket", "_edge"


Place = tuple  # a key and its tie


def _splits(keys: DataFrame, key: str, tie: str) -> list[Place]:
    n = BUCKETS_PER_PARTITION * shuffle_partitions(keys.sparkSession)
    share = n * SAMPLE_PER_BUCKET / max(1, keys.count())
    picked = keys.filter(sampled(5, share, key, tie)).select(key, tie)
    sample = sorted(tuple(r) for r in picked.distinct().collect())  # about SAMPLE_PER_BUCKET a bucket
    return sorted({sample[len(sample) * i // n] for i in range(1, n)}) if sample else []


def _places(batch: pa.RecordBatch, key: str, tie: str) -> list[Place]:
    one, two = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (key, tie))
    return list(zip(one, two, strict=True))


def _dealt(df: DataFrame, key: str, tie: str, splits: list[Place], sent: dict[Place, list[tuple[int, int]]]) -> DataFrame:
    """``df`` by bucket, rows of ``sent`` also in the buckets, and as the edges, that are given for them."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, buckets, edges = [], [], []
            for i, place in enumerate(_places(batch, key, tie)):
                rows.append(i)
                buckets.append(bisect_right(splits, place))
                edges.append(0)
                for b, edge in sent.get(place, ()):
                    rows.append(i)
                    buckets.append(b)
                    edges.append(edge)
            taken = batch.take(pa.array(rows, pa.int64())) if len(rows) > batch.num_rows else batch
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(buckets, pa.int64()), pa.array(edges, pa.int32())],
                names=[*batch.schema.names, BUCKET, EDGE],
            )

    dealt = df.mapInArrow(deal, plus(df.schema, T.StructField(BUCKET, T.LongType()), T.StructField(EDGE, T.IntegerType())))
    return dealt.repartition(shuffle_partitions(df.sparkSession), BUCKET).sortWithinPartitions(BUCKET, EDGE, key, tie)


def with_edges(df: DataFrame, key: str, tie: str, cyclic: bool = False) -> DataFrame:
    """``df`` in partitions of whole buckets, sorted by bucket, edge, ``key`` and ``tie``, both without nulls.

    ``_edge`` is 0 for the bucket's own rows and 1 for those that follow its last.
    ``cyclic``: the first row of all follows the last.
    """
    keys = df.select(key, tie)
    splits = _splits(keys, key, tie)
    place = F.struct(key, tie)
    ends = _dealt(keys, key, tie, splits, {}).groupBy(BUCKET).agg(F.min(place), F.max(place)).collect()  # one row a bucket
    first = [(b, tuple(low)) for b, low, _ in sorted(ends)]
    sent: dict[Place, list[tuple[int, int]]] = {}
    for i, (b, _) in enumerate(first):
        if i + 1 < len(first) or cyclic:
            sent.setdefault(first[(i + 1) % len(first)][1], []).append((b, 1))
    return _dealt(df, key, tie, splits, sent)


def with_runs(df: DataFrame, key: str, tie: str, run: str, keys: DataFrame) -> tuple[DataFrame, dict[int, tuple]]:
    """``df`` as by ``with_edges``, for rows that come in runs with equal ``run``; and the keys of runs at buckets' ends.

    Edges are the last row of the run before a bucket's first run (-1) and the first of
    the run after its last (1), however many buckets these runs fill. The dict has the
    first key of each bucket's first run, and the last key of its last run. ``keys`` is a
    stored table of the columns ``key``, ``tie`` and ``run``.
    """
    splits = _splits(keys, key, tie)
    ends = _dealt(keys, key, tie, splits, {}).mapInArrow(_run_ends(key, tie, run), _ENDS.format(keys.schema[key].dataType.simpleString()))
    runs: list[list] = []  # [first place, last place, run] in order, of the runs next to the ends of buckets
    held: dict[int, list[int]] = {}
    before = None
    for b, _, k, t, last_k, last_t, r in sorted(tuple(x) for x in ends.collect()):  # at most four rows a bucket
        if b != before and runs and runs[-1][2] == r:
            runs[-1][1] = (last_k, last_t)
        else:
            runs.append([(k, t), (last_k, last_t), r])
        held.setdefault(b, [len(runs) - 1]).append(len(runs) - 1)
        before = b
    sent: dict[Place, list[tuple[int, int]]] = {}
    for b, at in held.items():
        if at[0]:
            sent.setdefault(runs[at[0] - 1][1], []).append((b, -1))
        if at[-1] + 1 < len(runs):
            sent.setdefault(runs[at[-1] + 1][0], []).append((b, 1))
    return _dealt(df, key, tie, splits, sent), {b: (runs[at[0]][0][0], runs[at[-1]][1][0]) for b, at in held.items()}


_ENDS = "b long, i long, k {0}, t long, last_k {0}, last_t long, r long"


def _run_ends(key: str, tie: str, run: str):
    """The first two and the last two runs of each bucket, numbered by place."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, runs = None, []  # runs: number, first place, last place, run

        def ends() -> pa.RecordBatch:
            rows = [(bucket, i, *low, *high, r) for i, low, high, r in runs]
            kind = pa.int64() if not rows or isinstance(rows[0][2], int) else pa.string()
            kinds = [pa.int64(), pa.int64(), kind, pa.int64(), kind, pa.int64(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=["b", "i", "k", "t", "last_k", "last_t", "r"])

        for batch in batches:
            marks = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (BUCKET, run)]
            for place, b, r in zip(_places(batch, key, tie), *marks, strict=True):
                if b != bucket:
                    if runs:
                        yield ends()
                    bucket, runs = b, []
                if runs and runs[-1][3] == r:
                    runs[-1][2] = place
                else:
                    runs.append([runs[-1][0] + 1 if runs else 0, place, place, r])
                    if len(runs) > 4:
                        del runs[2]
        if runs:
            yield ends()

    return stream
