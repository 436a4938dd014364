"""Indicator aggregations over ``valid_trips`` (and raw ``trips`` for the benchmark set).

Each is a single partial+final hash aggregation: the partial side runs inside
the scan's codegen stage and only one row per group and task is shuffled, so a
feed holding almost every row (yellow) costs no more than its scan.

Money and distances are summed and averaged as the doubles they are: no value
is rounded before it is aggregated, and a NaN gives a NaN.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabflow.functions.columns import (
    card_tip_pct_value,
    int_mean,
    is_weekend,
    reused,
    share_pct,
    sql_round,
)

def ordered(df: DataFrame, *keys: str | Column) -> DataFrame:
    """The reference's result order, NULLs last in both directions (its default).

    Spark puts NULLs first in ascending order; a string key sorts ascending.
    The frames sorted here are aggregates of at most a few dozen rows.
    """
    cols = [F.col(k).asc_nulls_last() if isinstance(k, str) else k for k in keys]
    return df.orderBy(*cols)


def _desc(name: str) -> Column:
    return F.col(name).desc_nulls_last()


@reused
def _year() -> Column:
    return F.col("file_year").cast("long").alias("file_year")


@reused
def _month() -> Column:
    return F.col("file_month").cast("long").alias("file_month")


@reused
def _trips() -> Column:
    return F.count(F.lit(1)).alias("trips")


@reused
def _monthly_eda_aggs() -> list:
    return [
        _trips(),
        sql_round(F.avg("trip_distance")).alias("avg_distance_miles"),
        sql_round(int_mean("duration_minutes")).alias("avg_duration_minutes"),
        sql_round(F.avg("total_amount")).alias("avg_total_usd"),
    ]


@reused
def _monthly_aggs() -> list:
    return [
        _trips(),
        F.avg("trip_distance").alias("avg_distance_miles"),
        int_mean("duration_minutes").alias("avg_duration_minutes"),
        F.avg("total_amount").alias("avg_total_usd"),
        F.sum("total_amount").alias("revenue_usd"),
    ]


def monthly_eda(valid: DataFrame) -> DataFrame:
    agg = valid.groupBy(_year(), _month(), "taxi_type").agg(*_monthly_eda_aggs())
    return ordered(agg, "file_year", "file_month", "taxi_type")


def monthly_indicators(valid: DataFrame) -> DataFrame:
    agg = valid.groupBy(_year(), _month(), "taxi_type").agg(*_monthly_aggs())
    return ordered(agg, "file_year", "file_month", "taxi_type")


def monthly_volume(valid: DataFrame) -> DataFrame:
    agg = valid.groupBy(_year(), _month(), "taxi_type").agg(_trips())
    return ordered(agg, "file_year", "file_month", "taxi_type", "trips")


@reused
def _yearly_aggs(rounded: bool) -> list:
    r = sql_round if rounded else (lambda c, digits=2: c)
    # The tip mean averages arbitrary doubles, so its last bits depend on
    # summation order; the unrounded export fixes it at 8 decimals.
    tip = F.avg(card_tip_pct_value())
    return [
        _trips(),
        r(F.sum("total_amount")).alias("revenue_usd"),
        r(F.avg("total_amount")).alias("avg_total_usd"),
        r(F.avg("trip_distance")).alias("avg_distance_miles"),
        r(int_mean("duration_minutes")).alias("avg_duration_minutes"),
        (sql_round(tip) if rounded else sql_round(tip, 8)).alias("avg_card_tip_pct"),
        r(share_pct(is_weekend("pickup_datetime"))).alias("weekend_share_pct"),
    ]


def yearly_indicators(valid: DataFrame) -> DataFrame:
    return ordered(valid.groupBy(_year(), "taxi_type").agg(*_yearly_aggs(True)), "file_year", "taxi_type")


def yearly_indicators_raw(valid: DataFrame) -> DataFrame:
    return ordered(valid.groupBy(_year(), "taxi_type").agg(*_yearly_aggs(False)), "file_year", "taxi_type")


def yearly_notebook(valid: DataFrame) -> DataFrame:
    agg = valid.groupBy(_year(), "taxi_type").agg(
        _trips(),
        sql_round(F.avg("total_amount")).alias("avg_total"),
        sql_round(F.avg("trip_distance")).alias("avg_distance"),
    )
    return ordered(agg, "file_year", "taxi_type")


def card_tip_pct(valid: DataFrame) -> DataFrame:
    return valid.groupBy(_year(), "taxi_type").agg(sql_round(F.avg(card_tip_pct_value())).alias("avg_card_tip_pct"))


def weekend_share(valid: DataFrame) -> DataFrame:
    return valid.groupBy(_year(), "taxi_type").agg(
        sql_round(share_pct(is_weekend("pickup_datetime"))).alias("weekend_share_pct")
    )


def payment_mix(valid: DataFrame) -> DataFrame:
    """Trips per taxi and payment type; a NULL payment type is its own group."""
    return ordered(valid.groupBy("taxi_type", "payment_type").agg(_trips()), "taxi_type", _desc("trips"))


def payment_share(valid: DataFrame) -> DataFrame:
    """Share of each payment type within its taxi type.

    The window runs over the aggregated rows (a dozen), not over trips; its
    single-partition-per-taxi frame is therefore bounded by the number of
    payment codes, whatever the data size.
    """
    w = Window.partitionBy("taxi_type")
    mix = valid.groupBy("taxi_type", "payment_type").agg(_trips())
    shared = mix.withColumn("share_pct", sql_round(100.0 * F.col("trips").cast("double") / F.sum("trips").over(w)))
    return ordered(shared, "taxi_type", _desc("trips"))


def pickup_hour(valid: DataFrame) -> DataFrame:
    agg = valid.groupBy("taxi_type", F.hour("pickup_datetime").cast("long").alias("pickup_hour")).agg(_trips())
    return ordered(agg, "taxi_type", "pickup_hour")


@reused
def _totals_aggs() -> list:
    return [
        _trips(),
        F.sum("total_amount").alias("revenue"),
        F.avg("total_amount").alias("avg_total"),
        F.avg("trip_distance").alias("avg_distance"),
        int_mean("duration_minutes").alias("avg_duration"),
        sql_round(F.avg(card_tip_pct_value()), 8).alias("tip_pct"),
    ]


def totals(valid: DataFrame) -> DataFrame:
    """One global row: the dashboard's KPI inputs."""
    return valid.agg(*_totals_aggs())


# --- benchmark query set (over raw trips of a scope) -------------------------


def bench_count(trips: DataFrame) -> DataFrame:
    return trips.agg(F.count(F.lit(1)).alias("rows"))


def bench_summary(trips: DataFrame) -> DataFrame:
    return trips.groupBy("taxi_type").agg(
        _trips(),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("total_amount").alias("avg_total"),
    )


def bench_monthly(trips: DataFrame) -> DataFrame:
    agg = trips.groupBy(_year(), _month(), "taxi_type").agg(_trips(), F.sum("total_amount").alias("revenue"))
    return ordered(agg, "file_year", "file_month", "taxi_type", "trips", "revenue")
