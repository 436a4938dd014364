"""Footer facts of every file version ever read, as a stored table.

Opening a footer is a round trip to the store for each file. What a footer says
of a file version (its path, length and modification time) never changes, so it
is read once and kept in the shared folder: a listing is joined with that table
on executors, and only versions that are not in it are opened, there too. The
table is shared by all sessions that have the same shared folder. Each addition
is a folder of its own, which counts once it is complete, so that sessions that
add at the same time do not disturb each other; what two of them add twice is
read once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.session import glob_paths, work_dir
from cabflow.sources import footers as ft

VERSION = ["path", "length", "mtime"]
CATALOGUE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("mtime", T.LongType()),
        *[f for f in ft.FOOTER_SCHEMA.fields if f.name not in ("path", "bytes")],
    ]
)


def known(spark: SparkSession) -> DataFrame:
    """Every file version in the table."""
    folders = [p.rsplit("/", 1)[0] for p in glob_paths(spark, f"{work_dir(spark, 'footers')}/*/_SUCCESS")]
    if not folders:
        return spark.createDataFrame([], CATALOGUE_SCHEMA)
    return spark.read.schema(CATALOGUE_SCHEMA).parquet(*folders)


def facts(listing: DataFrame) -> DataFrame:
    """``CATALOGUE_SCHEMA`` of each listed file version (path, length, mtime)."""
    spark = listing.sparkSession
    held = known(spark)
    new = listing.join(held, VERSION, "left_anti").select(*VERSION)
    if not new.isEmpty():
        parts = 4 * spark.sparkContext.defaultParallelism
        read = ft.footers(new.select("path", "length").repartition(parts))
        rows = read.withColumnRenamed("bytes", "length").join(new, ["path", "length"])
        rows.select(*CATALOGUE_SCHEMA.names).write.parquet(work_dir(spark, f"footers/{uuid.uuid4().hex}"))
        held = known(spark)
    return listing.select(*VERSION).join(held, VERSION).dropDuplicates(VERSION).select(*CATALOGUE_SCHEMA.names)
