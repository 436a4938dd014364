from datetime import datetime

from cabflow.sources.schema import canonical_schema

BASE = {
    "taxi_type": "yellow",
    "filename": "yellow_tripdata_2024-01.parquet",
    "file_year": 2024,
    "file_month": 1,
    "trip_distance": 1.0,
    "total_amount": 10.0,
    "fare_amount": 8.0,
    "tip_amount": 1.0,
    "payment_type": 1,
    "passenger_count": 1.0,
}


def ts(s: str) -> datetime:
    fmt = "%Y-%m-%d %H:%M:%S.%f" if "." in s else "%Y-%m-%d %H:%M:%S"
    return datetime.strptime(s, fmt)


def trips_frame(spark, rows):
    """Canonical trips from partial dicts (unspecified columns NULL or BASE)."""
    schema = canonical_schema()
    full = []
    for r in rows:
        d = {**BASE, **r}
        full.append(tuple(d.get(f.name) for f in schema.fields))
    return spark.createDataFrame(full, schema)
