"""File-arrival audit as Spark jobs: expected months, missing files, status, gate, drift.

All inputs are one-row-per-file or one-row-per-month frames (the footer
manifest, the calendar); the only joins are between those small frames and
Spark picks their strategy from actual sizes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabflow.functions.columns import FILE_PERIOD_ANCHORED, FILE_PERIOD_LENGTH
from cabflow.session import work_dir
from cabflow.sources.schema import FEEDS


def expected_name(feed: Column, year: Column, month: Column) -> Column:
    """``<feed>_tripdata_YYYY-MM.parquet``."""
    return F.format_string("%s_tripdata_%04d-%02d.parquet", feed, year, month)


def calendar(years: DataFrame, year_col: str = "year", feeds: tuple[str, ...] = FEEDS) -> DataFrame:
    """Every (feed, year, month 1..12) for the years in ``years``, with its file name.

    Built by exploding arrays on the year rows: no cross join.
    """
    y = years.select(F.col(year_col).cast("int").alias("year")).distinct()
    cal = y.select(
        F.explode(F.array(*[F.lit(f) for f in feeds])).alias("taxi_type"),
        "year",
    ).select("taxi_type", "year", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    return cal.withColumn("file", expected_name(F.col("taxi_type"), F.col("year"), F.col("month")))


def year_span(frame: DataFrame, year_col: str) -> DataFrame:
    """Every year from the first to the last one present in ``frame``."""
    bounds = frame.agg(F.min(year_col).alias("lo"), F.max(year_col).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("year"))


def missing_months(cal: DataFrame, present_files: DataFrame, file_col: str = "file") -> DataFrame:
    """Expected months with no file ("not published")."""
    present = present_files.select(F.col(file_col).alias("file")).distinct()
    return cal.join(present, "file", "left_anti")


# Status labels of a file-arrival run.
STATUSES = ("new", "skipped", "missing", "failed")


def status_summary(cal: DataFrame, manifest: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Count per status and the bytes that are new.

    ``missing``: expected, no file; ``failed``: file present but not valid
    Parquet; ``skipped``: valid and already in the ledger of ingested files;
    ``new``: valid and not yet ingested.
    """
    files = manifest.select("file", "bytes", "valid_parquet")
    joined = cal.join(files, "file", "left")
    if ledger is not None:
        seen = ledger.select(F.col("file").alias("file")).distinct().withColumn("_seen", F.lit(True))
        joined = joined.join(seen, "file", "left")
    else:
        joined = joined.withColumn("_seen", F.lit(None).cast("boolean"))
    status = (
        F.when(F.col("bytes").isNull(), "missing")
        .when(~F.col("valid_parquet"), "failed")
        .when(F.coalesce(F.col("_seen"), F.lit(False)), "skipped")
        .otherwise("new")
    )
    per = joined.withColumn("status", status).groupBy("status").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum(F.when(F.col("status") == "new", F.col("bytes")).otherwise(0)).cast("long").alias("new_bytes"),
    )
    labels = per.sparkSession.createDataFrame([(s,) for s in STATUSES], "status string")
    return labels.join(per, "status", "left").fillna(0, subset=["files", "new_bytes"])


def invalid_files(manifest: DataFrame) -> DataFrame:
    return manifest.filter(~F.col("valid_parquet")).select("taxi_type", "year", "file", "bytes")


def gate(manifest: DataFrame, report: str | None = None) -> DataFrame:
    """Raise if there is no file or any file is not valid Parquet; else return the manifest.

    All offending files are written as JSON lines to ``report`` (default: a fresh
    folder in the shared work folder); the error has their number, the first
    names and that path.
    """
    counts = manifest.agg(
        F.count(F.lit(1)).alias("files"), F.count_if(~F.col("valid_parquet")).alias("invalid")
    ).first()
    if counts is None or counts["files"] == 0:
        raise FileNotFoundError("no Parquet files found")
    if counts["invalid"]:
        path = report or work_dir(manifest.sparkSession, f"invalid-files/{uuid.uuid4().hex}")
        bad = invalid_files(manifest)
        bad.write.mode("overwrite").json(path)
        names = [r.file for r in bad.orderBy("file").limit(20).collect()]
        more = " ..." if counts["invalid"] > len(names) else ""
        raise ValueError(f"{counts['invalid']} invalid Parquet files, all in {path}: {', '.join(names)}{more}")
    return manifest


def _period(file: str, year: str) -> Column:
    """``YYYY-MM`` of a file's name; a name without a month counts for its year."""
    suffix = F.substring(F.col(file), -FILE_PERIOD_LENGTH, FILE_PERIOD_LENGTH)
    return F.when(suffix.rlike(FILE_PERIOD_ANCHORED), F.substring(suffix, 1, 7)).otherwise(F.col(year).cast("string"))


# Fixed value: the part of a Spark schema's JSON that is read back (the footer signature).
_SIGNATURE_FIELDS = "struct<fields: array<struct<name: string, type: string>>>"


def schema_runs(manifest: DataFrame) -> DataFrame:
    """Runs of periods in which a feed's files carry a column with one type.

    A run goes on while the column is in some file of each next period that the feed has
    files of; a column that goes and returns, or switches its type and back, has several.
    ``files`` carry it so, ``in_every_file`` says whether these are all of the run's files.
    All frames have a row a file and column at most; windows run over a column's periods.
    """
    valid = manifest.filter(F.col("valid_parquet")).withColumn("period", _period("file", "year"))
    feed = Window.partitionBy("taxi_type").orderBy("period")
    periods = valid.groupBy("taxi_type", "period").agg(F.count(F.lit(1)).alias("_all")).withColumn("_nth", F.row_number().over(feed))
    fields = valid.select("taxi_type", "period", F.explode(F.from_json("signature", _SIGNATURE_FIELDS)["fields"]).alias("_f"))
    carried = fields.groupBy("taxi_type", "period", F.col("_f.name").alias("column_name"), F.col("_f.type").alias("type")).agg(
        F.count(F.lit(1)).alias("_files")
    )
    own = ["taxi_type", "column_name", "type"]
    island = F.col("_nth") - F.row_number().over(Window.partitionBy(*own).orderBy("_nth"))
    runs = carried.join(periods, ["taxi_type", "period"]).withColumn("_run", island).groupBy(*own, "_run")
    return runs.agg(
        F.min("period").alias("first_period"),
        F.max("period").alias("last_period"),
        F.count(F.lit(1)).alias("periods"),
        F.sum("_files").alias("files"),
        (F.sum("_files") == F.sum("_all")).alias("in_every_file"),
    ).drop("_run")


def schema_columns(manifest: DataFrame) -> DataFrame:
    """Per feed and year: files, and how many columns the narrowest and the widest of them has, and all together."""
    valid = manifest.filter(F.col("valid_parquet")).withColumn("year", F.col("year").cast("long"))
    names = valid.select("taxi_type", "year", F.explode("column_names").alias("_name")).distinct()
    total = names.groupBy("taxi_type", "year").agg(F.count(F.lit(1)).alias("distinct_columns"))
    counts = valid.groupBy("taxi_type", "year").agg(
        F.count(F.lit(1)).alias("files"),
        F.min("columns").cast("long").alias("fewest_columns"),
        F.max("columns").cast("long").alias("most_columns"),
    )
    return counts.join(total, ["taxi_type", "year"])


def schema_drift(manifest: DataFrame) -> DataFrame:
    """Per feed and column name: first / last year it occurs and in how many files."""
    cols = manifest.filter(F.col("valid_parquet")).select(
        "taxi_type", "year", F.explode("column_names").alias("column_name")
    )
    totals = manifest.filter(F.col("valid_parquet")).groupBy("taxi_type").agg(F.count(F.lit(1)).alias("_all"))
    return (
        cols.groupBy("taxi_type", "column_name")
        .agg(
            F.min("year").cast("long").alias("first_year"),
            F.max("year").cast("long").alias("last_year"),
            F.count(F.lit(1)).alias("files"),
        )
        .join(totals, "taxi_type")
        .withColumn("in_every_file", F.col("files") == F.col("_all"))
        .drop("_all")
    )
