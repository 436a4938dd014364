"""Indicator cube: every dashboard indicator from one scan.

The reference runs one query (one full scan) per exported indicator. Here one
aggregation by (year, month, taxi type, payment type, pickup hour, weekend)
keeps counts and sums — a few thousand rows however many trips there
are — and monthly, yearly, payment, hourly and total indicators are
re-aggregations of it. Means come from summed numerators and counts, never
from averaging averages, so the results equal the direct queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabflow.functions.columns import card_tip_pct_value, is_weekend, sql_round
from cabflow.operators.indicators import ordered


# Columns of the cube that are not keys, in the order of ``cube_aggs``.
CUBE_MEASURES = (
    "trips", "total_sum", "total_n", "distance_sum", "distance_n", "duration_sum", "duration_n", "tip_sum", "tip_n",
)


def cube_aggs() -> list[Column]:
    """Counts and sums that every indicator can be rebuilt from."""
    tip = card_tip_pct_value()
    return [
        F.count(F.lit(1)).alias("trips"),
        F.sum("total_amount").alias("total_sum"),
        F.count("total_amount").alias("total_n"),
        F.sum("trip_distance").alias("distance_sum"),
        F.count("trip_distance").alias("distance_n"),
        F.sum(F.col("duration_minutes").cast("long")).alias("duration_sum"),
        F.count("duration_minutes").alias("duration_n"),
        F.sum(tip).alias("tip_sum"),
        F.count(tip).alias("tip_n"),
    ]


def indicator_cube(valid: DataFrame) -> DataFrame:
    return valid.groupBy(
        F.col("file_year").cast("long").alias("file_year"),
        F.col("file_month").cast("long").alias("file_month"),
        "taxi_type",
        "payment_type",
        F.hour("pickup_datetime").cast("long").alias("pickup_hour"),
        is_weekend("pickup_datetime").alias("weekend"),
    ).agg(*cube_aggs())


def _mean(total: str, n: str) -> Column:
    return F.sum(total) / F.sum(n)


def _duration_mean() -> Column:
    return F.sum("duration_sum").cast("double") / F.sum("duration_n")


def _weekend_pct() -> Column:
    return 100.0 * (F.sum(F.when(F.col("weekend"), F.col("trips")).otherwise(0)).cast("double") / F.sum("trips"))


def _tip_mean() -> Column:
    return F.sum("tip_sum") / F.sum("tip_n")


def monthly_indicators(cube: DataFrame) -> DataFrame:
    return _monthly(cube).transform(lambda df: ordered(df, "file_year", "file_month", "taxi_type"))


def _monthly(cube: DataFrame) -> DataFrame:
    return cube.groupBy("file_year", "file_month", "taxi_type").agg(
        F.sum("trips").alias("trips"),
        _mean("distance_sum", "distance_n").alias("avg_distance_miles"),
        _duration_mean().alias("avg_duration_minutes"),
        _mean("total_sum", "total_n").alias("avg_total_usd"),
        F.sum("total_sum").alias("revenue_usd"),
    )


def yearly_indicators(cube: DataFrame, rounded: bool = True) -> DataFrame:
    return ordered(_yearly(cube, rounded), "file_year", "taxi_type")


def _yearly(cube: DataFrame, rounded: bool) -> DataFrame:
    r = sql_round if rounded else (lambda c, digits=2: c)
    return cube.groupBy("file_year", "taxi_type").agg(
        F.sum("trips").alias("trips"),
        r(F.sum("total_sum")).alias("revenue_usd"),
        r(_mean("total_sum", "total_n")).alias("avg_total_usd"),
        r(_mean("distance_sum", "distance_n")).alias("avg_distance_miles"),
        r(_duration_mean()).alias("avg_duration_minutes"),
        (sql_round(_tip_mean()) if rounded else sql_round(_tip_mean(), 8)).alias("avg_card_tip_pct"),
        r(_weekend_pct()).alias("weekend_share_pct"),
    )


def _mix(cube: DataFrame) -> DataFrame:
    return cube.groupBy("taxi_type", "payment_type").agg(F.sum("trips").alias("trips"))


def payment_mix(cube: DataFrame) -> DataFrame:
    return ordered(_mix(cube), "taxi_type", F.col("trips").desc_nulls_last())


def payment_share(cube: DataFrame) -> DataFrame:
    w = Window.partitionBy("taxi_type")
    shared = _mix(cube).withColumn(
        "share_pct", sql_round(100.0 * F.col("trips").cast("double") / F.sum("trips").over(w))
    )
    return ordered(shared, "taxi_type", F.col("trips").desc_nulls_last())


def pickup_hour(cube: DataFrame) -> DataFrame:
    return ordered(cube.groupBy("taxi_type", "pickup_hour").agg(F.sum("trips").alias("trips")), "taxi_type", "pickup_hour")


def totals(cube: DataFrame) -> DataFrame:
    return cube.agg(
        F.sum("trips").alias("trips"),
        F.sum("total_sum").alias("revenue"),
        _mean("total_sum", "total_n").alias("avg_total"),
        _mean("distance_sum", "distance_n").alias("avg_distance"),
        _duration_mean().alias("avg_duration"),
        sql_round(_tip_mean(), 8).alias("tip_pct"),
    )


def dashboard(valid: DataFrame) -> dict[str, DataFrame]:
    """All dashboard indicators from one scan; the cube is checkpointed (small, reliable)."""
    return dashboard_of(indicator_cube(valid).checkpoint(eager=True))


def dashboard_of(cube: DataFrame) -> dict[str, DataFrame]:
    return {
        "monthly_indicators": monthly_indicators(cube),
        "yearly_indicators": yearly_indicators(cube),
        "yearly_indicators_raw": yearly_indicators(cube, rounded=False),
        "payment_mix": payment_mix(cube),
        "payment_share": payment_share(cube),
        "pickup_hour": pickup_hour(cube),
        "totals": totals(cube),
    }
