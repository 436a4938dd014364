"""Normalise raw feeds into the canonical relation; split valid from rejected trips."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.functions.columns import FILE_PERIOD_ANCHORED, FILE_PERIOD_LENGTH, minute_diff, plus_hours, reused
from cabflow.sources.schema import CANONICAL_TYPES, SOURCE_NAMES


# Hidden per-file metadata column of Spark's file sources: the source file URI.
META_PATH = "_metadata.file_path"


def _quote(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def normalize_feed(raw: DataFrame, feed: str, path_col: str = META_PATH) -> DataFrame:
    """Project one feed's raw columns onto the canonical 25 columns.

    Source names are matched case-insensitively (``Airport_fee`` vs
    ``airport_fee``); a column the files do not carry becomes a typed NULL;
    columns the canonical relation does not know are dropped. Every value is
    cast to its canonical type, which is how INT32/INT64/DOUBLE drift between
    files is absorbed (the reader itself only widens INT32).

    The projection is handed over as SQL expressions in one call: building 25
    Column objects one by one costs over a thousand driver round trips.
    """
    present = {c.lower(): c for c in raw.columns}
    period = FILE_PERIOD_ANCHORED.replace("\\", "\\\\")
    path = _quote(path_col)
    suffix = f"substring({path}, -{FILE_PERIOD_LENGTH}, {FILE_PERIOD_LENGTH})"  # see functions.columns.file_period
    exprs = [
        f"'{feed}' AS taxi_type",
        f"{path} AS filename",
        f"CAST(regexp_extract({suffix}, '{period}', 1) AS INT) AS file_year",
        f"CAST(regexp_extract({suffix}, '{period}', 2) AS INT) AS file_month",
    ]
    for canon, src in SOURCE_NAMES[feed].items():
        t = CANONICAL_TYPES[canon].simpleString()
        if src is None or src.lower() not in present:
            exprs.append(f"CAST(NULL AS {t}) AS {canon}")
        else:
            exprs.append(f"CAST(`{present[src.lower()]}` AS {t}) AS {canon}")
    return raw.selectExpr(*exprs)


def union_feeds(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL BY NAME, no de-duplication."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _valid_conjuncts() -> list[Column]:
    p, d = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return [
        p.isNotNull(),
        d.isNotNull(),
        F.year(p) == F.col("file_year"),
        d > p,
        d <= plus_hours(p, 24),
        F.col("trip_distance") >= 0,
        F.col("total_amount") >= 0,
    ]


@reused
def valid_condition() -> Column:
    return reduce(lambda a, b: a & b, _valid_conjuncts())


@reused
def _duration() -> Column:
    return minute_diff("pickup_datetime", "dropoff_datetime")


def with_duration(df: DataFrame) -> DataFrame:
    return df.withColumn("duration_minutes", _duration())


def valid_trips(trips: DataFrame, years: tuple[int, ...] | None = None) -> DataFrame:
    """Trips usable for indicators, plus ``duration_minutes``.

    A NULL distance or total fails its comparison and drops the row (SQL
    three-valued logic); zero distance is kept. The month is not checked.
    ``years``: the scope ``trips`` was read for. A valid pickup lies in its file's
    year, so the scope's range on the pickup is implied; stated, it reaches the
    scan and skips row groups of stray dates.
    """
    if years:
        start, end = f"{min(years):04d}-01-01", f"{max(years) + 1:04d}-01-01"
        pickup = F.col("pickup_datetime")
        trips = trips.filter((pickup >= F.lit(start).cast("timestamp_ntz")) & (pickup < F.lit(end).cast("timestamp_ntz")))
    return with_duration(trips.filter(valid_condition()))


# Rejection reason labels, one per failed rule.
REJECTION_REASONS = (
    "null_timestamps",
    "pickup_outside_file_year",
    "nonpositive_duration",
    "duration_over_24h",
    "negative_or_missing_distance",
    "negative_or_missing_total",
)


def rejected_trips(trips: DataFrame) -> DataFrame:
    """Complement of ``valid_trips`` with an array of reasons (categories overlap)."""
    p, d = F.col("pickup_datetime"), F.col("dropoff_datetime")
    tests = [
        p.isNull() | d.isNull(),
        F.year(p) != F.col("file_year"),
        d <= p,
        d > plus_hours(p, 24),
        F.col("trip_distance").isNull() | (F.col("trip_distance") < 0),
        F.col("total_amount").isNull() | (F.col("total_amount") < 0),
    ]
    reasons = F.array_compact(
        F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(name)) for name, t in zip(REJECTION_REASONS, tests)])
    )
    return with_duration(
        trips.filter(~F.coalesce(valid_condition(), F.lit(False)))
    ).withColumn("reasons", reasons)
