"""Several aggregations of the trips from one scan, by grouping sets.

The reference runs one query, and so one scan, for each result. Here a single
aggregation has a grouping set for each of them; a task combines all sets while
it reads, and only groups are shuffled. Rows that fail the quality rules are told
apart by a grouping column, so raw and valid counts come from the same scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabflow.functions.columns import is_weekend
from cabflow.operators.cube import CUBE_MEASURES, cube_aggs
from cabflow.operators.normalize import valid_condition, with_duration
from cabflow.operators.quality import COUNTERS, quality_aggs
from cabflow.operators.quantiles import MEASURES

SET = "_set"  # which grouping set a row belongs to
FILE = ("taxi_type", "file_year", "filename")
CUBE = ("file_year", "file_month", "taxi_type", "payment_type", "pickup_hour", "weekend", "_valid")


def flagged(trips: DataFrame) -> DataFrame:
    """Trips with duration, the cube's columns and whether they are valid."""
    return with_duration(trips).withColumns(
        {
            "_valid": F.coalesce(valid_condition(), F.lit(False)),
            "pickup_hour": F.hour("pickup_datetime").cast("long"),
            "weekend": is_weekend("pickup_datetime"),
        }
    )


def grouped(rows: DataFrame, sets: dict[str, tuple[str, ...]], aggs: list[Column]) -> DataFrame:
    """One aggregation with all of ``sets``; ``_set`` has the name of the set that a row is of."""
    columns = sorted({c for s in sets.values() for c in s})
    bits = {n: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in s) for n, s in sets.items()}
    if len(set(bits.values())) < len(bits):
        raise ValueError("two grouping sets have the same columns")
    name = F.create_map(*[x for n, b in bits.items() for x in (F.lit(b).cast("long"), F.lit(n))])
    out = rows.groupingSets([list(s) for s in sets.values()], *columns).agg(F.grouping_id().alias("_id"), *aggs)
    return out.withColumn(SET, name[F.col("_id")]).drop("_id")


def analysis_groups(trips: DataFrame) -> DataFrame:
    """Everything that the analysis run exports, as groups: files, the indicator cube, and value counts."""
    sets = {"file": FILE, "cube": CUBE, **{m: ("taxi_type", column, "_valid") for m, column in MEASURES}}
    rows = flagged(trips)
    values = rows.withColumns({f"_{m}": F.col(column) for m, column in MEASURES})  # a grouping column is null in other sets
    named = {n: tuple(f"_{n}" if c == dict(MEASURES).get(n) else c for c in s) for n, s in sets.items()}
    return grouped(values, named, [*quality_aggs(), *cube_aggs()])


def audit_of(groups: DataFrame) -> DataFrame:
    """``quality.audit_by_file`` from the groups."""
    own = groups.filter(F.col(SET) == "file")
    return own.select("taxi_type", F.col("file_year").cast("long").alias("file_year"), "filename", *COUNTERS)


def cube_of(groups: DataFrame) -> DataFrame:
    """``cube.indicator_cube`` from the groups."""
    keys = [F.col(c).cast("long").alias(c) if c in ("file_year", "file_month") else F.col(c) for c in CUBE if c != "_valid"]
    return groups.filter((F.col(SET) == "cube") & F.col("_valid")).select(*keys, *CUBE_MEASURES)


def value_counts_of(groups: DataFrame) -> DataFrame:
    """(taxi_type, measure, value, n) of the valid trips from the groups."""
    out = None
    for m, _ in MEASURES:
        own = groups.filter((F.col(SET) == m) & F.col("_valid"))
        own = own.select("taxi_type", F.lit(m).alias("measure"), F.col(f"_{m}").cast("double").alias("value"), F.col("trips").alias("n"))
        out = own if out is None else out.unionByName(own)
    return out
