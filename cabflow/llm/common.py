"""Helpers shared by the operators: shared folder, table access, Arrow batch slicing, column names."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.session import remove, work_dir

BATCH_BYTES = 4 << 20


def once(key: tuple, make: Callable):
    """``make()``, called once in each Python process.

    Functions reach the workers by value, with copies of their module's globals, so
    what a worker is to keep between tasks is held apart from any module of this package.
    """
    held = sys.modules.setdefault("_cabflow_kept", types.ModuleType("_cabflow_kept")).__dict__
    if key not in held:
        held[key] = make()
    return held[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the cluster's shared folder (``spark.checkpoint.dir``)."""
    return work_dir(spark, f"llm/{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder, which outlives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def unstore(*frames: DataFrame) -> None:
    """Remove stored tables that no later plan reads."""
    for df in frames:
        remove(df.sparkSession, df.stored_at)


def fresh_name(columns: list[str], name: str) -> str:
    """``name``, with underscores appended until no column has it (Spark compares without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def plus(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    return T.StructType([*schema.fields, *fields])


def sampled(seed: int, share: float, *columns: str) -> Column:
    """About this share of all values, by their 64-bit hash; any share above 0, however small, counts."""
    if share >= 1:
        return F.lit(True)
    return F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns]) < F.lit(int(share * 2**64) - 2**63)


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column as strings without nulls (null: empty)."""
    column = batch.column(batch.schema.get_field_index(name))
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column, "")


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column without nulls, without copying the bytes."""
    width = np.int64 if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type) else np.int32
    _, offsets, data = array.buffers()
    if len(array) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, width)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that ``column`` holds about ``limit`` bytes in each, or one row that holds more."""
    for batch in batches:
        at, start, n = np.cumsum(np.r_[0, _lengths(batch, column)]), 0, batch.num_rows
        while start < n:
            end = max(start + 1, int(np.searchsorted(at, at[start] + limit, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def _lengths(batch: pa.RecordBatch, column: str) -> np.ndarray:
    lengths = pc.binary_length(batch.column(batch.schema.get_field_index(column)))
    return pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False).astype(np.int64)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges [start, start + length)."""
    lengths = np.asarray(lengths, np.int64)
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.repeat(np.asarray(starts, np.int64) - (ends - lengths), lengths) + np.arange(ends[-1])


def int_lists(flat: np.ndarray, offsets: np.ndarray, kind: pa.DataType = pa.int32()) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.astype(kind.to_pandas_dtype())))


def append(batch: pa.RecordBatch, names: list[str], arrays: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *names])
