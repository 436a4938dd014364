"""Write the lineitem-derived trips as a drifted monthly-file lake.

Layout and drift follow the raw feeds: ``<root>/<feed>/<year>/
<feed>_tripdata_YYYY-MM.parquet``; the first year lacks ``airport_fee`` /
``ehail_fee``; the fee column is ``airport_fee`` in the second year and
``Airport_fee`` in the third; ``VendorID`` is INT32 in the first year and INT64
later; ``passenger_count`` is INT64, then DOUBLE, then INT64; the third year
adds an unknown ``cbd_fee`` column. Spark writes each feed in one job per drift
layout (first, second, third, later years), all at once, one file per month; the driver then
renames those few dozen files into place. The narrow lineitem rows are shuffled, each month
to a task of its own, and become trips there, without a sort.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.session import file_identity, glob_paths, unsorted_writes, work_dir
from cabflow.sources.fixture import feed_of_line, lineitem_scope, trips_of
from cabflow.sources.schema import FEEDS, SOURCE_NAMES


# Bumped whenever the lake's layout or drift rules change, so old lakes are not reused.
LAYOUT_VERSION = "l3"


def _drift(feed: str, year_index: int) -> dict:
    first, second = year_index == 0, year_index == 1
    return {
        "omit": {"airport_fee", "ehail_fee"} if first else set(),
        "rename": {"airport_fee": "airport_fee" if second else "Airport_fee"},
        "types": {
            "vendor_id": "int" if first else "bigint",
            "passenger_count": "double" if second else "bigint",
        },
        "extra": {"cbd_fee": F.lit(0.75)} if year_index == 2 else {},
    }


def raw_projection(trips: DataFrame, feed: str, year_index: int) -> DataFrame:
    """Canonical rows of one feed/year projected back onto that year's raw columns."""
    d = _drift(feed, year_index)
    cols = []
    for canon, src in SOURCE_NAMES[feed].items():
        if src is None or canon in d["omit"]:
            continue
        name = d["rename"].get(canon, src) if canon == "airport_fee" else src
        c = F.col(canon)
        if canon in d["types"]:
            c = c.cast(d["types"][canon])
        cols.append(c.alias(name))
    cols += [v.alias(k) for k, v in d["extra"].items()]
    cols.append(F.col("file_year").alias("_year"))
    cols.append(F.lpad(F.col("file_month").cast("string"), 2, "0").alias("_month"))
    return trips.select(*cols)


def _move(spark: SparkSession, src: str, dst: str) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    s, d = jvm.org.apache.hadoop.fs.Path(src), jvm.org.apache.hadoop.fs.Path(dst)
    fs = s.getFileSystem(conf)
    fs.mkdirs(d.getParent())
    if not fs.rename(s, d):
        raise OSError(f"rename failed: {src} -> {dst}")


def months_of(lineitem: DataFrame, feed: str, years: list[int]) -> DataFrame:
    """Trips of one feed and these years, each month's in a partition of its own.

    The lineitem rows are dealt, before they become trips: they are less than half as wide.
    """
    year, month = F.year("l_shipdate"), F.month("l_shipdate")
    part = lineitem.filter((feed_of_line() == feed) & year.isin(*years))
    at = (F.array_position(F.array(*[F.lit(y) for y in years]), year) - 1) * 12 + month - 1
    return trips_of(part.repartitionById(12 * len(years), at.cast("int")))


def write_lake(spark: SparkSession, lineitem: DataFrame, root: str) -> str:
    """Write the trips of ``lineitem`` as the drifted raw lake under ``root``; returns ``root``."""
    root = root.rstrip("/")
    years = sorted(r.year for r in lineitem.select(F.year("l_shipdate").alias("year")).distinct().collect())  # a handful of ints
    layouts = [(i, years[i : i + 1]) for i in range(min(3, len(years)))] + ([(3, years[3:])] if years[3:] else [])

    def write(feed: str, i: int, span: list[int]) -> None:
        staging = f"{root}/_staging/{feed}-{i}"
        # The raw format is one file per feed-month, and one file has one writer:
        # each month goes to one task. This builds test fixtures from lineitem;
        # the library itself only reads such lakes (split by maxPartitionBytes).
        (
            raw_projection(months_of(lineitem, feed, span), feed, i)
            .write.mode("overwrite")
            .partitionBy("_year", "_month")
            .parquet(staging)
        )
        for path in glob_paths(spark, f"{staging}/_year=*/_month=*/*.parquet"):
            year, month = (path.split(f"/_{k}=")[1].split("/")[0] for k in ("year", "month"))
            _move(spark, path, f"{root}/{feed}/{year}/{feed}_tripdata_{year}-{month}.parquet")

    with unsorted_writes(spark), ThreadPoolExecutor(len(FEEDS) * len(layouts)) as jobs:  # independent jobs of few tasks each
        list(jobs.map(lambda a: write(*a), [(feed, *layout) for feed in FEEDS for layout in layouts]))
    return root


def _write_marker(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True).close()


def fixture_lake(spark: SparkSession, sf_dir: str) -> str:
    """The lake for ``sf_dir`` in the shared work folder, written once per session folder.

    Each build goes to a fresh folder and is published by a ``_READY`` marker,
    so an interrupted build is never read.
    """
    ident = file_identity(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    tag = f"{sf_dir.rstrip('/').replace('/', '_').strip('_')}-{ident}-{LAYOUT_VERSION}"
    base = work_dir(spark, f"lakes/{tag}")
    ready = glob_paths(spark, f"{base}/*/_READY")
    if ready:
        return ready[0].rsplit("/", 1)[0]
    root = f"{base}/{uuid.uuid4().hex}"
    write_lake(spark, lineitem_scope(spark, sf_dir), root)
    _write_marker(spark, f"{root}/_READY")
    return root
