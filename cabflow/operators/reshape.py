"""Pivots, shares, series and top-k over the (small) aggregated indicator frames.

These replace the reference's pandas post-processing. Inputs are aggregates
with a few dozen rows, so none of these adds a scan; pivots list their values
up front so Spark plans them without a distinct-values job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.functions.columns import sql_round
from cabflow.operators.quantiles import exact_quantiles
from cabflow.sources.schema import FEEDS

# Payment codes for card and cash.
CARD, CASH = 1, 2


def pivot_by_taxi(frame: DataFrame, value_col: str, index: str = "file_year") -> DataFrame:
    """``index`` x taxi type of one value column (one row per index value)."""
    return frame.groupBy(index).pivot("taxi_type", sorted(FEEDS)).agg(F.first(value_col))


def yellow_green_ratio(yearly: DataFrame) -> DataFrame:
    """Yellow trips per green trip and year; NULL when the year has no green row."""
    wide = pivot_by_taxi(yearly, "trips")
    return wide.select(
        "file_year",
        F.col("yellow").alias("yellow_trips"),
        F.col("green").alias("green_trips"),
        F.when(F.col("green").isNotNull(), F.col("yellow") / F.greatest(F.col("green"), F.lit(1))).alias("ratio"),
    )


def card_cash_share(payment: DataFrame) -> DataFrame:
    """Card vs cash as % of card+cash trips per taxi type (other codes excluded)."""
    wide = (
        payment.filter(F.col("payment_type").isin(CARD, CASH))
        .groupBy("taxi_type")
        .pivot("payment_type", [CARD, CASH])
        .agg(F.sum("trips"))
        .fillna(0, subset=[str(CARD), str(CASH)])
    )
    card, cash = F.col(str(CARD)), F.col(str(CASH))
    both = card + cash
    return wide.select(
        "taxi_type",
        card.alias("card_trips"),
        cash.alias("cash_trips"),
        F.when(both > 0, card / both * 100.0).alias("card_pct"),
        F.when(both > 0, cash / both * 100.0).alias("cash_pct"),
    )


def monthly_series(monthly: DataFrame) -> DataFrame:
    return monthly.select(
        F.make_date("file_year", "file_month", F.lit(1)).cast("timestamp_ntz").alias("period"),
        "taxi_type",
        "trips",
        (F.col("trips") / 1e6).alias("trips_millions"),
    )


def hourly_series(hourly: DataFrame) -> DataFrame:
    return hourly.select("taxi_type", "pickup_hour", (F.col("trips") / 1e6).alias("trips_millions"))


def quantile_panel(quantiles: DataFrame) -> DataFrame:
    cols = ["distance_p50", "distance_p99", "duration_p50", "duration_p99", "total_p50", "total_p99"]
    return quantiles.select("taxi_type", *cols)


def skew_check(valid: DataFrame) -> DataFrame:
    """Median, p99 and mean distance per taxi type, from one scan; a mean above the median flags right skew."""
    q = exact_quantiles(valid, ["taxi_type"], "trip_distance", [0.5, 0.99])
    wide = q.groupBy("taxi_type").agg(
        F.first(F.when(F.col("prob") == 0.5, F.col("value")), ignorenulls=True).alias("distance_p50"),
        F.first(F.when(F.col("prob") == 0.99, F.col("value")), ignorenulls=True).alias("distance_p99"),
        F.first("mean").alias("mean_distance"),
    )
    return wide.withColumn("mean_above_median", F.col("mean_distance") > F.col("distance_p50"))


def kpi_cards(totals: DataFrame) -> DataFrame:
    """The six dashboard numbers, scaled and rounded (numbers, not formatted text)."""
    return totals.select(
        "trips",
        sql_round(F.col("revenue") / 1e9, 2).alias("revenue_billions"),
        sql_round("avg_total", 2).alias("avg_total"),
        sql_round("avg_distance", 2).alias("avg_distance"),
        sql_round("avg_duration", 1).alias("avg_duration"),
        sql_round("tip_pct", 1).alias("tip_pct"),
    )


def busiest_month(monthly: DataFrame) -> DataFrame:
    """Arg-max of trips; ties go to the earliest period, then taxi type."""
    return monthly.select("file_year", "file_month", "taxi_type", "trips").orderBy(
        F.col("trips").desc(), "file_year", "file_month", "taxi_type"
    ).limit(1)


def top_hour(hourly: DataFrame) -> DataFrame:
    return hourly.orderBy(F.col("trips").desc(), "taxi_type", "pickup_hour").limit(1)


def sample_rows(trips: DataFrame, n: int = 10, seed: int = 42) -> DataFrame:
    """Uniform random sample of ``n`` rows: a per-task top-n on a random key.

    ``TABLESAMPLE (n ROWS)`` would return the first rows; ordering by
    ``rand(seed)`` plans as TakeOrderedAndProject, so each task keeps n rows.
    """
    return trips.orderBy(F.rand(seed)).limit(n)


def describe(df: DataFrame) -> DataFrame:
    """One row per column of a relation: name, type, and how many of its rows have a value."""
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(f.name)).alias(f"_{i}") for i, f in enumerate(df.schema.fields)])
    entries = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("column_type"),
            F.col(f"_{i}").alias("values"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select("rows", F.explode(F.array(*entries)).alias("_c")).select(
        "_c.column_name", "_c.column_type", "rows", "_c.values"
    )
