"""Coverage and data-quality counters over the raw ``trips`` relation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.functions.columns import basename, feed_of, file_period, plus_hours, reused
from cabflow.operators.indicators import ordered


def _files_and_rows(df: DataFrame, keys: dict[str, Column], file_col: Column) -> DataFrame:
    """COUNT(DISTINCT file), COUNT(*) per key without an Expand.

    First aggregate to one row per (key, file) — at most one row per input
    file, whatever the row count — then re-aggregate that tiny frame.
    """
    per_file = df.groupBy(*[c.alias(n) for n, c in keys.items()], file_col.alias("_file")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    return per_file.groupBy(*keys).agg(F.count(F.lit(1)).alias("files"), F.sum("_rows").alias("rows"))


def coverage(trips: DataFrame) -> DataFrame:
    """Files and rows per taxi type and file year."""
    cov = _files_and_rows(
        trips,
        {"taxi_type": F.col("taxi_type"), "file_year": F.col("file_year").cast("long")},
        F.col("filename"),
    )
    return ordered(cov, "file_year", "taxi_type")


def audit_by_file(trips: DataFrame) -> DataFrame:
    """Rows and defect counters per feed, year and file: one row a file, from one scan.

    ``coverage_of`` and ``quality_of`` are sums of it, for runs that need both.
    """
    keys = ["taxi_type", F.col("file_year").cast("long").alias("file_year"), "filename"]
    return trips.groupBy(*keys).agg(*quality_aggs())


def coverage_of(audit: DataFrame) -> DataFrame:
    cov = audit.groupBy("taxi_type", "file_year").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))
    return ordered(cov, "file_year", "taxi_type")


def quality_of(audit: DataFrame) -> DataFrame:
    counters = [c for c in audit.columns if c not in ("taxi_type", "file_year", "filename")]
    q = audit.groupBy("taxi_type", "file_year").agg(*[F.sum(c).alias(c) for c in counters])
    return ordered(q, "file_year", "taxi_type")


def file_row_counts(all_files: DataFrame, path_col: str = "filename") -> DataFrame:
    """Same numbers as ``coverage`` but keyed by regexes over the file path only.

    ``all_files`` is one scan over both feeds; it is an independent code path
    (no feed literal, no normalisation) used to reconcile against coverage.
    Rows are first counted per path (one short hash per row); the regexes then
    run once per file on that tiny frame, not once per row.
    """
    per_path = all_files.groupBy(F.col(path_col).alias("_path")).agg(F.count(F.lit(1)).alias("_rows"))
    p = F.col("_path")
    counts = per_path.groupBy(feed_of(p).alias("taxi_type"), file_period(p, 1).cast("long").alias("year")).agg(
        F.count_distinct(basename(p)).alias("files"), F.sum("_rows").alias("rows")
    )
    return ordered(counts, "year", "taxi_type")


def quality(trips: DataFrame) -> DataFrame:
    """Rows and seven overlapping defect counters per taxi type and file year."""
    q = trips.groupBy("taxi_type", F.col("file_year").cast("long").alias("file_year")).agg(*quality_aggs())
    return ordered(q, "file_year", "taxi_type")


# Columns of a quality report that are not keys, in the order of ``quality_aggs``.
COUNTERS = (
    "rows", "null_timestamps", "pickup_outside_file_year", "nonpositive_duration", "duration_over_24h",
    "nonpositive_distance", "negative_total", "missing_or_zero_passengers",
)


@reused
def quality_aggs() -> list:
    p, d = F.col("pickup_datetime"), F.col("dropoff_datetime")
    counters = {
        "null_timestamps": p.isNull() | d.isNull(),
        "pickup_outside_file_year": F.year(p) != F.col("file_year"),
        "nonpositive_duration": d <= p,
        "duration_over_24h": d > plus_hours(p, 24),
        "nonpositive_distance": F.col("trip_distance") <= 0,
        "negative_total": F.col("total_amount") < 0,
        "missing_or_zero_passengers": F.col("passenger_count").isNull() | (F.col("passenger_count") <= 0),
    }
    return [
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(cond).cast("long").alias(name) for name, cond in counters.items()],
    ]
