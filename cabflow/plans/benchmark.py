"""Direct Parquet vs materialised table: three queries over three cumulative year scopes.

Every timed run builds its DataFrame afresh and consumes all result rows
(``collect`` of an aggregate), one warm-up then ``reps`` repetitions. Neither
build runs a job: the lake's footers are known from the warm-up, the table's
schema is declared. The samples become a DataFrame; statistics and the strategy
pivot are aggregations over it. This is a harness whose numbers differ from run
to run, so it is a library function (``run_benchmark``), not a registered query.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.operators import indicators as ind
from cabflow.plans.materialize import read_materialized
from cabflow.plans.sinks import export_csv
from cabflow.session import glob_paths
from cabflow.sources.lake import bare_rows, read_trips


def scopes(spark: SparkSession, root: str) -> tuple[tuple[int, ...], ...]:
    """Three cumulative year scopes: the first year, the first two, every year."""
    files = glob_paths(spark, f"{root.rstrip('/')}/*/[0-9][0-9][0-9][0-9]/*.parquet")
    years = sorted({int(f.rsplit("/", 2)[1]) for f in files})  # the <year> folder of each file
    return (tuple(years[:1]), tuple(years[:2]), tuple(years))


QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "count": ind.bench_count,
    "summary": ind.bench_summary,
    "monthly": ind.bench_monthly,
}
STRATEGIES = ("parquet", "table")


def count_lake(spark: SparkSession, root: str, years: tuple[int, ...]) -> DataFrame:
    """The bare count of a lake's scope: a scan without any column."""
    return ind.bench_count(bare_rows(spark, root, years))


def source(spark: SparkSession, strategy: str, root: str, table: str, years: tuple[int, ...]) -> DataFrame:
    if strategy == "parquet":
        return read_trips(spark, root, years)
    return read_materialized(spark, table, years)


def timed(build: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    build().collect()
    return time.perf_counter() - start


def run_matrix(spark: SparkSession, root: str, table: str, reps: int = 3, warmup: int = 1) -> DataFrame:
    """One row per timed sample: years, year_count, query, strategy, rep, seconds."""
    records = []
    for years in scopes(spark, root):
        label = "+".join(map(str, years))
        for qname, q in QUERIES.items():
            for strategy in STRATEGIES:
                if (qname, strategy) == ("count", "parquet"):
                    build = lambda: count_lake(spark, root, years)
                else:
                    build = lambda: q(source(spark, strategy, root, table, years))
                for _ in range(warmup):
                    timed(build)
                for rep in range(reps):
                    records.append((label, len(years), qname, strategy, rep, timed(build)))
    return spark.createDataFrame(
        records, "years string, year_count int, query string, strategy string, rep int, seconds double"
    )


def bench_stats(samples: DataFrame) -> DataFrame:
    """Median / min / max seconds and repetitions per (scope, query, strategy)."""
    return samples.groupBy("years", "year_count", "query", "strategy").agg(
        F.percentile("seconds", 0.5).alias("median_seconds"),
        F.min("seconds").alias("min_seconds"),
        F.max("seconds").alias("max_seconds"),
        F.count(F.lit(1)).alias("repetitions"),
    )


def bench_pivot(stats: DataFrame) -> DataFrame:
    """Long -> wide by strategy, with the table speed-up (parquet / table; above 1 = table faster)."""
    wide = stats.groupBy("years", "query").pivot("strategy", list(STRATEGIES)).agg(F.avg("median_seconds"))
    return wide.withColumn("table_speedup", F.col("parquet") / F.col("table"))


def run_benchmark(spark: SparkSession, root: str, table: str, out_dir: str, reps: int = 3) -> dict[str, str]:
    """The whole matrix with its two exports: statistics per strategy, and the strategies side by side."""
    stats = bench_stats(run_matrix(spark, root, table, reps))
    base = out_dir.rstrip("/")
    return {
        "benchmark": export_csv(stats, f"{base}/benchmark.csv"),
        "benchmark_comparison": export_csv(bench_pivot(stats), f"{base}/benchmark_comparison.csv"),
    }
