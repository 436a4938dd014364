"""Query keys -> callables ``(spark, sf_dir) -> DataFrame``.

Every key reads the driver's tables (through the lineitem-derived ``trips``
relation, or a file lake Spark writes from it) over their whole extent.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.functions.columns import basename, feed_of, sql_round
from cabflow.operators import indicators as ind
from cabflow.operators import quality as qual
from cabflow.operators import quantiles as qnt
from cabflow.operators import reshape as rs
from cabflow.operators.normalize import rejected_trips, valid_trips
from cabflow.operators.reconcile import reconcile_lake
from cabflow.plans import benchmark as bm
from cabflow.plans import ingest as ing
from cabflow.plans.materialize import materialize, read_materialized, table_location
from cabflow.plans.sinks import export_csv, export_json, read_csv, read_json
from cabflow.plans.views import register_views
from cabflow.session import copy_folder, work_dir
from cabflow.sources import lake
from cabflow.sources.fixture import SCOPE_YEARS, fixture_trips
from cabflow.sources.footers import manifest
from cabflow.sources.schema import FEEDS
from cabflow.sources.testlake import fixture_lake
from cabflow.streaming.incremental import ingest_incremental, ingest_stream, read_ingested

Query = Callable[[SparkSession, str], DataFrame]


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_trips(spark, sf_dir)


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_trips(fixture_trips(spark, sf_dir))


def _on_valid(op) -> Query:
    return lambda spark, sf_dir: op(_valid(spark, sf_dir))


def _on_trips(op) -> Query:
    return lambda spark, sf_dir: op(_trips(spark, sf_dir))


def _rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rejected_trips(_trips(spark, sf_dir))
    return r.withColumn("reasons", F.array_join("reasons", ","))


# Interpolated quantiles are compared at 6 decimals:
# engines differ in the last binary digit of ``lo + (hi - lo) * frac``.
def _quantiles_6(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = qnt.quantiles(_valid(spark, sf_dir))
    return q.select("taxi_type", *[sql_round(c, 6).alias(c) for c in q.columns if c != "taxi_type"])


def _quantiles_list_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = qnt.quantiles_list(_valid(spark, sf_dir))
    cols = [
        sql_round(F.element_at(f"{m}_quantiles", i + 1), 6).alias(f"{m}_p{p}")
        for m, _ in qnt.MEASURES
        for i, p in enumerate((50, 90, 99))
    ]
    return q.select("taxi_type", *cols)


def _round6(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[sql_round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


def _yearly_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ind.yearly_indicators_raw(_valid(spark, sf_dir))


def _skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round6(rs.skew_check(_valid(spark, sf_dir)), ["distance_p50", "distance_p99"])


def _panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.quantile_panel(_quantiles_6(spark, sf_dir))


def _sample(trips: DataFrame) -> DataFrame:
    """How many rows the sample has, and how many of them are rows of the relation."""
    keys = ["filename", "vendor_id", "pickup_datetime", "pickup_location_id", "total_amount"]
    picked = rs.sample_rows(trips).select(*keys)
    return picked.join(trips.select(*keys), keys, "left_semi").agg(F.count(F.lit(1)).alias("in_trips")).select(
        F.lit(10).cast("long").alias("wanted"), "in_trips"
    )


QUERIES: dict[str, Query] = {
    "valid_trips": _on_valid(lambda v: v),
    "rejected_trips": _rejected,
    "coverage": _on_trips(qual.coverage),
    "quality": _on_trips(qual.quality),
    "monthly_eda": _on_valid(ind.monthly_eda),
    "monthly_indicators": _on_valid(ind.monthly_indicators),
    "monthly_volume": _on_valid(ind.monthly_volume),
    "yearly_indicators": _on_valid(ind.yearly_indicators),
    "yearly_indicators_raw": _on_valid(ind.yearly_indicators_raw),
    "yearly_notebook": _on_valid(ind.yearly_notebook),
    "card_tip_pct": _on_valid(ind.card_tip_pct),
    "weekend_share": _on_valid(ind.weekend_share),
    "payment_mix": _on_valid(ind.payment_mix),
    "payment_share": _on_valid(ind.payment_share),
    "pickup_hour": _on_valid(ind.pickup_hour),
    "totals": _on_valid(ind.totals),
    "quantiles": _quantiles_6,
    "quantiles_list": _quantiles_list_flat,
    "pivot_avg_total": lambda s, d: rs.pivot_by_taxi(_yearly_raw(s, d), "avg_total_usd"),
    "pivot_avg_distance": lambda s, d: rs.pivot_by_taxi(_yearly_raw(s, d), "avg_distance_miles"),
    "yellow_green_ratio": lambda s, d: rs.yellow_green_ratio(_yearly_raw(s, d)),
    "card_cash_share": _on_valid(lambda v: rs.card_cash_share(ind.payment_mix(v))),
    "monthly_series": _on_valid(lambda v: rs.monthly_series(ind.monthly_indicators(v))),
    "hourly_series": _on_valid(lambda v: rs.hourly_series(ind.pickup_hour(v))),
    "quantile_panel": _panel,
    "skew_check": _skew,
    "kpi_cards": _on_valid(lambda v: rs.kpi_cards(ind.totals(v))),
    "busiest_month": _on_valid(lambda v: rs.busiest_month(ind.monthly_indicators(v))),
    "top_hour": _on_valid(lambda v: rs.top_hour(ind.pickup_hour(v))),
    "sample_rows": _on_trips(_sample),
}


# --- file layer: a drifted monthly-file lake that Spark writes from lineitem ----


def _lake(spark: SparkSession, sf_dir: str) -> str:
    return fixture_lake(spark, sf_dir)


def _base(df: DataFrame) -> DataFrame:
    """Relation with the file column reduced to its base name (paths differ per machine)."""
    return df.withColumn("filename", basename("filename"))


def _lake_trips(spark: SparkSession, sf_dir: str, years: tuple[int, ...] | None = None) -> DataFrame:
    return lake.read_trips(spark, _lake(spark, sf_dir), years)


def _scan_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = lake.feed_paths(spark, _lake(spark, sf_dir), "yellow")
    no_columns = T.StructType([])
    files = spark.read.schema(no_columns).parquet(*paths).select(F.col("_metadata.file_path").alias("path"))
    per_path = files.groupBy("path").agg(F.count(F.lit(1)).alias("rows"))  # name derived once per file
    return per_path.select(F.lit("yellow").alias("taxi_type"), basename("path").alias("filename"), "rows")


def _scan_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = lake.read_all(spark, _lake(spark, sf_dir))
    per_path = files.groupBy("filename").agg(F.count(F.lit(1)).alias("rows"))  # lineage derived once per file
    return per_path.select(feed_of("filename").alias("taxi_type"), basename("filename").alias("filename"), "rows")


def _views(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    register_views(spark, _lake_trips(spark, sf_dir))
    return _base(spark.table(name))


def _table_path(spark: SparkSession, sf_dir: str) -> str:
    root = _lake(spark, sf_dir)
    return work_dir(spark, f"tables/{root.rstrip('/').rsplit('/', 1)[1]}/trips_materialized")


def _table(spark: SparkSession, sf_dir: str) -> str:
    path = _table_path(spark, sf_dir)
    if table_location(spark, path) is None:
        materialize(_lake_trips(spark, sf_dir), path)
    return path


def _materialize_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = materialize(_lake_trips(spark, sf_dir), _table_path(spark, sf_dir))
    t = read_materialized(spark, path)
    return t.groupBy(F.col("file_year").cast("long").alias("file_year"), "taxi_type").agg(
        F.count(F.lit(1)).alias("rows")
    )


def _materialized(spark: SparkSession, sf_dir: str, years=None, taxi=None) -> DataFrame:
    return read_materialized(spark, _table(spark, sf_dir), years, taxi)


def _export_dir(spark: SparkSession, name: str) -> str:
    return work_dir(spark, f"exports/{uuid.uuid4().hex}/{name}")


def _sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ind.yearly_indicators(_valid(spark, sf_dir))
    return read_csv(spark, export_csv(df, _export_dir(spark, "yearly_indicators.csv")), df.schema)


def _sink_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = ind.yearly_indicators_raw(_valid(spark, sf_dir))
    return read_json(spark, export_json(df, _export_dir(spark, "yearly_indicators_raw.json")), df.schema)


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per file: validity, rows and columns (sizes differ from writer to writer)."""
    m = manifest(spark, _lake(spark, sf_dir))
    return m.select(
        "taxi_type", F.col("year").cast("long").alias("year"), "file", "valid_parquet", "rows",
        F.col("columns").cast("long").alias("columns"),
    )


def _integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per feed and year: files, valid files, and files of a plausible size."""
    m = manifest(spark, _lake(spark, sf_dir))
    return m.groupBy("taxi_type", F.col("year").cast("long").alias("year")).agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if("valid_parquet").alias("valid_files"),
        F.count_if(F.col("bytes") >= 12).alias("sized_files"),
    )


def _gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows behind the gate: it raises unless every file is valid."""
    return ing.gate(manifest(spark, _lake(spark, sf_dir))).agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows")
    )


def _describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.describe(_lake_trips(spark, sf_dir)).select(
        "column_name", F.when(F.col("column_type") == "bigint", "long").otherwise(F.col("column_type")).alias("column_type"), "rows", "values"
    )


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = ing.year_span(_trips(spark, sf_dir), "file_year")
    return ing.calendar(years).select(
        "taxi_type", F.col("year").cast("long").alias("year"), F.col("month").cast("long").alias("month"), "file"
    )


def _missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = manifest(spark, _lake(spark, sf_dir))
    return ing.missing_months(_calendar(spark, sf_dir), m)


def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of every expected month, with the first year's files as the ledger."""
    m = manifest(spark, _lake(spark, sf_dir))
    first = m.agg(F.min("year").alias("year"))
    ledger = m.join(first, "year").select("file")
    out = ing.status_summary(ing.calendar(ing.year_span(m, "year")), m, ledger)
    return out.select("status", "files", (F.col("new_bytes") > 0).alias("has_new_bytes"))


def _ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of the table after two arrivals, the second with all years; its ledger is its own."""
    root = _lake(spark, sf_dir)
    base = work_dir(spark, f"ingest/{uuid.uuid4().hex}")
    ingest_incremental(spark, root, f"{base}/table", f"{base}/state", years=SCOPE_YEARS)
    ingest_incremental(spark, root, f"{base}/table", f"{base}/state")
    return qual.coverage(read_ingested(spark, f"{base}/table"))


def _ingest_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of the table, by status of its files, after all years but two were removed from the lake."""
    root = _lake(spark, sf_dir)
    base = work_dir(spark, f"ingest/{uuid.uuid4().hex}")
    ingest_incremental(spark, root, f"{base}/table", f"{base}/state")
    for year in SCOPE_YEARS:
        for feed in FEEDS:
            copy_folder(spark, f"{root}/{feed}/{year}", f"{base}/lake/{feed}/{year}")
    ingest_incremental(spark, f"{base}/lake", f"{base}/table", f"{base}/state")
    return qual.coverage(read_ingested(spark, f"{base}/table"))


def _ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of the table that the stream made of the whole lake."""
    base = work_dir(spark, f"ingest/{uuid.uuid4().hex}")
    ingest_stream(spark, _lake(spark, sf_dir), f"{base}/table", f"{base}/state")
    return qual.coverage(read_ingested(spark, f"{base}/table"))


def _reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile_lake(_lake_trips(spark, sf_dir), lake.read_all(spark, _lake(spark, sf_dir)))


ALL_YEARS = None  # the benchmark's widest scope: every year of the lake

QUERIES.update(
    {
        "scan_feed": _scan_feed,
        "scan_evolving_schema": lambda s, d: _base(_lake_trips(s, d)),
        "scan_filename": lambda s, d: _base(_lake_trips(s, d)).select("taxi_type", "filename").distinct(),
        "scan_file_period": lambda s, d: _base(_lake_trips(s, d))
        .select("filename", F.col("file_year").cast("long"), F.col("file_month").cast("long"))
        .distinct(),
        "scan_scoped_years": lambda s, d: _base(_lake_trips(s, d, SCOPE_YEARS)),
        "scan_mixed_feeds": _scan_mixed,
        "file_row_counts": lambda s, d: qual.file_row_counts(lake.read_all(s, _lake(s, d))),
        "normalize_yellow": lambda s, d: _base(lake.read_feed(s, _lake(s, d), "yellow")),
        "normalize_green": lambda s, d: _base(lake.read_feed(s, _lake(s, d), "green")),
        "union_by_name": lambda s, d: _base(_lake_trips(s, d)),
        "view_trips": lambda s, d: _views(s, d, "trips"),
        "view_valid_trips": lambda s, d: _views(s, d, "valid_trips"),
        "materialize_trips": _materialize_counts,
        "materialized_lookup": lambda s, d: _base(_materialized(s, d, (1997,), "green")),
        "filter_year_in": lambda s, d: _base(_materialized(s, d, SCOPE_YEARS)),
        "bench_count": lambda s, d: bm.count_lake(s, _lake(s, d), ALL_YEARS),
        "bench_summary": lambda s, d: ind.bench_summary(_lake_trips(s, d, ALL_YEARS)),
        "bench_monthly": lambda s, d: ind.bench_monthly(_lake_trips(s, d, ALL_YEARS)),
        "bench_count_table": lambda s, d: ind.bench_count(_materialized(s, d, ALL_YEARS)),
        "bench_summary_table": lambda s, d: ind.bench_summary(_materialized(s, d, ALL_YEARS)),
        "bench_monthly_table": lambda s, d: ind.bench_monthly(_materialized(s, d, ALL_YEARS)),
        "sink_csv": _sink_csv,
        "sink_json": _sink_json,
        "ingest_calendar": _calendar,
        "ingest_missing_months": _missing,
        "ingest_status_summary": _status,
        "ingest_manifest": _manifest,
        "ingest_integrity": _integrity,
        "ingest_gate": _gate,
        "schema_drift": lambda s, d: ing.schema_drift(manifest(s, _lake(s, d))),
        "schema_runs": lambda s, d: ing.schema_runs(manifest(s, _lake(s, d))),
        "schema_columns": lambda s, d: ing.schema_columns(manifest(s, _lake(s, d))),
        "ingest_incremental": _ingest,
        "ingest_removed": _ingest_removed,
        "ingest_stream": _ingest_stream,
        "describe_trips": _describe,
        "reconcile_counts": _reconcile,
    }
)


# Nullable integer codes are compared as DOUBLE (here and in the SQL oracle):
# converted to pandas, a BIGINT column holding NULLs has another type from Spark
# than from the SQL engine, so equal values could hash differently.
NULLABLE_INTEGERS = {"payment_type", "trip_type"}
NULLABLE_PER_KEY = {"rejected_trips": {"duration_minutes"}, "reconcile_counts": {"file_year"}}


def _comparable(key: str, fn: Query) -> Query:
    cols = NULLABLE_INTEGERS | NULLABLE_PER_KEY.get(key, set())

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        if not cols.intersection(df.columns):
            return df
        return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])

    return run


QUERIES = {k: _comparable(k, f) for k, f in QUERIES.items()}
