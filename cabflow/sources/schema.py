"""Canonical trip relation: column order, types, and per-feed source names."""

from __future__ import annotations

from pyspark.sql import types as T

FEEDS = ("yellow", "green")

# Canonical column order and Spark type of the normalised relation.
CANONICAL: list[tuple[str, T.DataType]] = [
    ("taxi_type", T.StringType()),
    ("filename", T.StringType()),
    ("file_year", T.IntegerType()),
    ("file_month", T.IntegerType()),
    ("vendor_id", T.LongType()),
    ("pickup_datetime", T.TimestampNTZType()),
    ("dropoff_datetime", T.TimestampNTZType()),
    ("passenger_count", T.DoubleType()),
    ("trip_distance", T.DoubleType()),
    ("rate_code_id", T.DoubleType()),
    ("store_and_fwd_flag", T.StringType()),
    ("pickup_location_id", T.LongType()),
    ("dropoff_location_id", T.LongType()),
    ("payment_type", T.LongType()),
    ("fare_amount", T.DoubleType()),
    ("extra", T.DoubleType()),
    ("mta_tax", T.DoubleType()),
    ("tip_amount", T.DoubleType()),
    ("tolls_amount", T.DoubleType()),
    ("improvement_surcharge", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("congestion_surcharge", T.DoubleType()),
    ("airport_fee", T.DoubleType()),
    ("ehail_fee", T.DoubleType()),
    ("trip_type", T.LongType()),
]
CANONICAL_NAMES = [n for n, _ in CANONICAL]
CANONICAL_TYPES = dict(CANONICAL)

# Source column per canonical column, per feed. None = the feed
# never carries it and the canonical column is a typed NULL.
SOURCE_NAMES: dict[str, dict[str, str | None]] = {
    "yellow": {
        "vendor_id": "VendorID",
        "pickup_datetime": "tpep_pickup_datetime",
        "dropoff_datetime": "tpep_dropoff_datetime",
        "passenger_count": "passenger_count",
        "trip_distance": "trip_distance",
        "rate_code_id": "RatecodeID",
        "store_and_fwd_flag": "store_and_fwd_flag",
        "pickup_location_id": "PULocationID",
        "dropoff_location_id": "DOLocationID",
        "payment_type": "payment_type",
        "fare_amount": "fare_amount",
        "extra": "extra",
        "mta_tax": "mta_tax",
        "tip_amount": "tip_amount",
        "tolls_amount": "tolls_amount",
        "improvement_surcharge": "improvement_surcharge",
        "total_amount": "total_amount",
        "congestion_surcharge": "congestion_surcharge",
        "airport_fee": "Airport_fee",
        "ehail_fee": None,
        "trip_type": None,
    },
    "green": {
        "vendor_id": "VendorID",
        "pickup_datetime": "lpep_pickup_datetime",
        "dropoff_datetime": "lpep_dropoff_datetime",
        "passenger_count": "passenger_count",
        "trip_distance": "trip_distance",
        "rate_code_id": "RatecodeID",
        "store_and_fwd_flag": "store_and_fwd_flag",
        "pickup_location_id": "PULocationID",
        "dropoff_location_id": "DOLocationID",
        "payment_type": "payment_type",
        "fare_amount": "fare_amount",
        "extra": "extra",
        "mta_tax": "mta_tax",
        "tip_amount": "tip_amount",
        "tolls_amount": "tolls_amount",
        "improvement_surcharge": "improvement_surcharge",
        "total_amount": "total_amount",
        "congestion_surcharge": "congestion_surcharge",
        "airport_fee": None,
        "ehail_fee": "ehail_fee",
        "trip_type": "trip_type",
    },
}


def canonical_schema(with_duration: bool = False) -> T.StructType:
    fields = [T.StructField(n, t, True) for n, t in CANONICAL]
    if with_duration:
        fields.append(T.StructField("duration_minutes", T.LongType(), True))
    return T.StructType(fields)
