"""Result sinks: CSV with header and JSON lines, written in parallel by the tasks.

Results are aggregates (a few dozen rows) but the writers do not funnel them
through one task: a directory of part files is what every reader accepts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def export_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def export_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
