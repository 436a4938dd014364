"""Cross-check totals computed along independent code paths.

* per (taxi, year): rows by ``coverage`` (normalised relation) vs rows by
  ``file_row_counts`` (path regexes over one mixed scan);
* per (taxi, year): valid trips summed from the monthly indicators vs the
  yearly indicators;
* per taxi: valid trips by payment type vs by pickup hour.

``reconcile_lake`` reads the lake twice at most: all totals of the normalised
relation come from one scan, each counted by a grouping set of its own, and the
other scan reads no column. Inputs of the joins are aggregates of a few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabflow.operators.onepass import SET, flagged, grouped
from cabflow.operators.quality import file_row_counts
from cabflow.session import work_dir

# Each total has its own grouping set over the rows.
TOTALS = {
    "coverage": ("taxi_type", "file_year", "filename"),
    "monthly": ("taxi_type", "file_year", "file_month", "_valid"),
    "yearly": ("taxi_type", "file_year", "_valid"),
    "payment": ("taxi_type", "payment_type", "_valid"),
    "hourly": ("taxi_type", "pickup_hour", "_valid"),
}


def _pair(check: str, left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    j = left.join(right, keys, "full_outer")
    year = F.col("file_year").cast("long") if "file_year" in keys else F.lit(None).cast("long")
    return j.select(
        F.lit(check).alias("check"),
        "taxi_type",
        year.alias("file_year"),
        F.col("left").cast("long").alias("left"),
        F.col("right").cast("long").alias("right"),
        F.coalesce(F.col("left") == F.col("right"), F.lit(False)).alias("ok"),
    )


def reconcile_counts(
    coverage: DataFrame,
    file_rows: DataFrame,
    monthly: DataFrame,
    yearly: DataFrame,
    payment: DataFrame,
    hourly: DataFrame,
) -> DataFrame:
    k = ["taxi_type", "file_year"]
    c = coverage.select("taxi_type", "file_year", F.col("rows").alias("left"))
    f = file_rows.select("taxi_type", F.col("year").alias("file_year"), F.col("rows").alias("right"))
    m = monthly.groupBy(*k).agg(F.sum("trips").alias("left"))
    y = yearly.select(*k, F.col("trips").alias("right"))
    p = payment.groupBy("taxi_type").agg(F.sum("trips").alias("left"))
    h = hourly.groupBy("taxi_type").agg(F.sum("trips").alias("right"))
    return (
        _pair("coverage_vs_files", c, f, k)
        .unionByName(_pair("monthly_vs_yearly", m, y, k))
        .unionByName(_pair("payment_vs_hourly", p, h, ["taxi_type"]))
    )


def reconcile_lake(trips: DataFrame, all_files: DataFrame) -> DataFrame:
    """``reconcile_counts`` of a lake: its normalised relation, and the bare scan of its files' paths."""
    work_dir(trips.sparkSession)  # sets the checkpoint folder where the session has none
    groups = grouped(flagged(trips), TOTALS, [F.count(F.lit(1)).alias("trips")])
    groups = groups.withColumn("file_year", F.col("file_year").cast("long")).checkpoint()  # files and some thousand rows
    own = {n: groups.filter((F.col(SET) == n) & (F.col("_valid") if "_valid" in s else F.lit(True))) for n, s in TOTALS.items()}
    coverage = own["coverage"].groupBy("taxi_type", "file_year").agg(F.sum("trips").alias("rows"))
    return reconcile_counts(coverage, file_row_counts(all_files), own["monthly"], own["yearly"], own["payment"], own["hourly"])
