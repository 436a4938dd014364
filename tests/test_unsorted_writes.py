"""The test lake is dealt as narrow rows and written without a sort."""

from datetime import datetime

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from cabflow.session import unsorted_writes
from cabflow.sources import lake
from cabflow.sources.fixture import LINEITEM_SCHEMA, trips_of
from cabflow.sources.testlake import months_of, write_lake

KEY = "spark.sql.maxConcurrentOutputFileWriters"


def lines(spark, months=((1992, 1), (1992, 2), (1993, 1), (1994, 12), (1996, 3), (1996, 4), (1998, 3)), n=12):
    """``n`` lineitem rows of each month, dealt over the table; the first row of each comes twice."""
    rows = [
        (1000 * i + m, 7 * i + 1, i + 2, i % 7 + 1, float(i), 100.5 + i, 0.05, 0.02, "RAN"[i % 3] if i % 4 else None, "O", datetime(y, m, i + 1))
        for i in [0, *range(n)]
        for y, m in months
    ]
    return spark.createDataFrame(rows, LINEITEM_SCHEMA)


@pytest.fixture
def settings(spark, monkeypatch):
    """What the setting was at each Parquet write."""
    seen = []
    real = DataFrameWriter.parquet

    def watched(self, *a, **k):
        seen.append(self._spark.conf.get(KEY))
        return real(self, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    return seen


def test_each_month_is_dealt_to_a_task_as_narrow_rows(spark):
    li = lines(spark).repartition(5)
    years = [1996, 1998]
    got = months_of(li, "yellow", years)
    per_task = got.groupBy(F.spark_partition_id().alias("task")).agg(F.collect_set(F.struct("file_year", "file_month")).alias("months"))
    assert [len(r.months) for r in per_task.collect()] == [1, 1, 1]
    want = trips_of(li).filter("taxi_type = 'yellow' AND file_year IN (1996, 1998)")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    shuffled = plan.split("RepartitionByExpression")[1]
    assert "_tripdata_" in plan and "_tripdata_" not in shuffled  # trips are made behind the shuffle


def test_the_lake_is_written_without_a_sort(spark, tmp_path, settings):
    li, before = lines(spark), spark.conf.get(KEY)
    root = write_lake(spark, li, f"file:{tmp_path}/lake")
    assert len(settings) == 8 and all(int(s) > 0 for s in settings) and spark.conf.get(KEY) == before
    want = {(r.taxi_type, r.filename): r["count"] for r in trips_of(li).groupBy("taxi_type", "filename").count().collect()}
    got = lake.read_trips(spark, root).groupBy("taxi_type", F.element_at(F.split("filename", "/"), -1).alias("filename")).count()
    assert {(r.taxi_type, r.filename): r["count"] for r in got.collect()} == want
    assert len(lake.feed_paths(spark, root, "yellow")) + len(lake.feed_paths(spark, root, "green")) == len(want)


def test_the_last_of_overlapping_blocks_restores_the_setting(spark):
    before = spark.conf.get(KEY)
    one, two = unsorted_writes(spark, 5), unsorted_writes(spark, 7)
    one.__enter__()
    two.__enter__()
    one.__exit__(None, None, None)
    assert spark.conf.get(KEY) == "7"
    two.__exit__(None, None, None)
    assert spark.conf.get(KEY) == before
    with pytest.raises(ZeroDivisionError), unsorted_writes(spark):
        1 / 0
    assert spark.conf.get(KEY) == before
