"""Physical copy of the raw relation, partitioned for fast (year, taxi type) lookups.

The reference keeps a database table plus an index on (file_year, taxi_type);
here the equivalent is a Parquet table partitioned by those two columns:
lookups by them prune whole directories (``PartitionFilters``), and rows are
clustered by month inside each partition so month predicates skip row groups.

Rows are dealt by (file_year, taxi_type) with the ``rebalance`` hint before they
are written: adaptive execution merges small partitions and splits large ones by
``spark.sql.adaptive.advisoryPartitionSizeInBytes``, so the number of files
follows the bytes of a partition, not the number of scan tasks (which would each
leave a file in every partition they touch), and a dominant feed is split over
many tasks. ``maxRecordsPerFile`` bounds a file's rows besides.

Replacement is atomic for readers: each materialisation is written to a fresh
version folder and published afterwards by creating a marker file; readers take
the newest published version. A job that dies midway leaves the previous
version readable (``overwrite`` would already have deleted it), and its own
folder is removed. Old versions go once they are past ``keep`` and older than
``grace_seconds``, so that a reader that began on one can finish.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.session import glob_paths, parquet_v2, remove
from cabflow.sources.schema import CANONICAL_NAMES, canonical_schema

PARTITION_COLUMNS = ("file_year", "taxi_type")
VERSIONS, DATA = "_versions", "data"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def table_location(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest published version of the table at ``path`` (None if none)."""
    markers = glob_paths(spark, f"{path.rstrip('/')}/{VERSIONS}/*")
    if not markers:
        return None
    return f"{path.rstrip('/')}/{DATA}/{max(m.rsplit('/', 1)[1] for m in markers)}"


def materialize(
    trips: DataFrame, path: str, max_records_per_file: int = 5_000_000, keep: int = 2, grace_seconds: int = 6 * 3600
) -> str:
    """Create or replace the partitioned table at ``path`` from ``trips``; returns ``path``."""
    spark = trips.sparkSession
    base = path.rstrip("/")
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"  # sorts by publication time
    try:
        (
            trips.hint("rebalance", *PARTITION_COLUMNS)
            .sortWithinPartitions(*PARTITION_COLUMNS, "file_month")
            .write.mode("errorifexists")
            .option("maxRecordsPerFile", max_records_per_file)
            .partitionBy(*PARTITION_COLUMNS)
            .parquet(f"{base}/{DATA}/{version}")
        )
    except Exception:
        remove(spark, f"{base}/{DATA}/{version}")
        raise
    marker, fs = _fs(spark, f"{base}/{VERSIONS}/{version}")
    fs.create(marker, False).close()  # publish: creating a file is atomic
    for old in sorted(m.rsplit("/", 1)[1] for m in glob_paths(spark, f"{base}/{VERSIONS}/*"))[:-keep]:
        if time.time_ns() - int(old.split("-")[0]) > grace_seconds * 10**9:
            remove(spark, f"{base}/{VERSIONS}/{old}")
            remove(spark, f"{base}/{DATA}/{old}")
    return path


def read_materialized(
    spark: SparkSession,
    path: str,
    years: tuple[int, ...] | None = None,
    taxi: str | None = None,
) -> DataFrame:
    """The table in canonical column order, optionally pruned to years / one taxi type.

    Read through the V2 Parquet source: partition filters prune directories
    and a bare ``COUNT(*)`` is answered from footers where the session has
    ``spark.sql.parquet.aggregatePushdown`` on, as ``get_session`` sets it.
    """
    location = table_location(spark, path)
    if location is None:
        raise FileNotFoundError(f"no published version of the table at {path}")
    with parquet_v2(spark):
        df = spark.read.schema(canonical_schema()).parquet(location)  # declared: no inference job
    if years is not None:
        df = df.filter(F.col("file_year").isin(*years))
    if taxi is not None:
        df = df.filter(F.col("taxi_type") == taxi)
    return df.select(*CANONICAL_NAMES)
