"""Stand-in ``trips`` relation derived from the driver's ``lineitem`` table.

Deterministic: every column is a rule over lineitem columns, so Spark and an
independent SQL engine produce the same rows. Every lineitem row is a trip and
its ship year is the trip's file year; the rules plant every kind of data-quality defect the reference's
report counts (NULL timestamps, reversed and over-long trips, pickups outside
the file year, zero or negative distance, negative totals, missing payment).

Distances and totals are multiples of 1/128: finer than a cent, and exact in
binary, so their sums are the same in any order of addition and by any engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.sources.schema import CANONICAL, CANONICAL_NAMES

# Ship years used as fixed scopes by the scoped-read and lookup keys.
SCOPE_YEARS = (1996, 1997)

# The lineitem columns the stand-in reads. Declared, not inferred: no inference
# job, and the ship date is wall-clock time whatever the session's settings.
LINEITEM_SCHEMA = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz"
)


def _secs(n: Column, ts: Column) -> Column:
    return F.timestamp_add("SECOND", n.cast("long"), ts)


def lineitem_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole lineitem table (only the columns the stand-in uses)."""
    return spark.read.schema(LINEITEM_SCHEMA).parquet(f"{sf_dir}/lineitem.parquet")


def feed_of_line() -> Column:
    """The feed of a lineitem row's trip."""
    return F.when(F.col("l_returnflag") == "R", "green").otherwise("yellow")


def fixture_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25-column canonical relation built from lineitem (no file I/O besides the scan)."""
    return trips_of(lineitem_scope(spark, sf_dir))


def trips_of(li: DataFrame) -> DataFrame:
    """The trips of lineitem rows, row by row."""
    ok = F.col("l_orderkey")
    green = F.col("l_returnflag") == "R"
    taxi = feed_of_line()

    pickup_offset = (
        (F.col("l_partkey") % 1440) * 60
        + F.col("l_suppkey") % 60
        + F.when(ok % 211 == 0, 31_622_400).otherwise(0)
    )
    pickup = _secs(pickup_offset, F.col("l_shipdate"))
    ride = F.col("l_quantity") * 60 + F.col("l_linenumber") * 7
    dropoff = (
        F.when(ok % 307 == 0, F.lit(None).cast("timestamp_ntz"))
        .when(ok % 97 == 0, _secs(F.lit(-300), pickup))
        .when(ok % 193 == 0, _secs(F.lit(90_000), pickup))
        .otherwise(_secs(ride, pickup))
    )
    price = F.floor(F.col("l_extendedprice") * 128.0).cast("double") / 128.0
    cols = {
        "taxi_type": taxi,
        "filename": F.concat(taxi, F.lit("_tripdata_"), F.date_format("l_shipdate", "yyyy-MM"), F.lit(".parquet")),
        "file_year": F.year("l_shipdate"),
        "file_month": F.month("l_shipdate"),
        "vendor_id": F.col("l_linenumber"),
        "pickup_datetime": pickup,
        "dropoff_datetime": dropoff,
        "passenger_count": F.when(ok % 10 == 0, F.lit(None)).otherwise(F.col("l_linenumber") - 1),
        "trip_distance": F.when(ok % 53 == 0, F.lit(0.0))
        .when(ok % 401 == 0, F.lit(-1.5))
        .otherwise(F.col("l_partkey").cast("double") / 128),
        "rate_code_id": F.col("l_linenumber"),
        "store_and_fwd_flag": F.when(F.col("l_linestatus") == "O", "Y").otherwise("N"),
        "pickup_location_id": F.col("l_partkey") % 263 + 1,
        "dropoff_location_id": F.col("l_suppkey") % 263 + 1,
        "payment_type": F.when(ok % 29 == 0, F.lit(None)).otherwise(F.col("l_partkey") % 6),
        "fare_amount": F.when(ok % 61 == 0, F.lit(0.0)).otherwise(F.col("l_quantity")),
        "extra": F.lit(0.5),
        "mta_tax": F.col("l_tax"),
        "tip_amount": F.col("l_quantity") * F.col("l_discount"),
        "tolls_amount": F.lit(0.0),
        "improvement_surcharge": F.lit(1.0),
        "total_amount": F.when(ok % 71 == 0, -price).otherwise(price),
        "congestion_surcharge": F.lit(2.5),
        "airport_fee": F.when(~green, F.lit(1.75)),
        "ehail_fee": F.when(green, F.lit(0.0)),
        "trip_type": F.when(green, F.lit(1)),
    }
    return li.select(*[cols[n].cast(t).alias(n) for n, t in CANONICAL]).select(*CANONICAL_NAMES)
