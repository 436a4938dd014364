"""Named relations in the session catalog, for SQL users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cabflow.operators.normalize import valid_trips
from cabflow.sources.lake import read_trips


def register_views(spark: SparkSession, trips: DataFrame) -> None:
    """Create or replace the lazy views ``trips`` and ``valid_trips``."""
    trips.createOrReplaceTempView("trips")
    valid_trips(spark.table("trips")).createOrReplaceTempView("valid_trips")


def register_scoped_view(spark: SparkSession, root: str, years: tuple[int, ...], name: str) -> DataFrame:
    """Create or replace the lazy view ``name`` over the listed years of a lake's trips."""
    read_trips(spark, root, years).createOrReplaceTempView(name)
    return spark.table(name)
