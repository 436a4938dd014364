"""Ingestion writes a task's files without a sort of their rows."""

import os
import shutil
from functools import partial

import pytest
from pyspark.sql import DataFrameWriter

from cabflow.session import unsorted_writes
from cabflow.sources import lake
from cabflow.streaming import incremental
from cabflow.streaming.incremental import ingest_incremental, read_ingested

KEY = "spark.sql.maxConcurrentOutputFileWriters"


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


@pytest.mark.parametrize("files", [None, 1])
def test_ingestion_writes_without_a_sort(spark, lake_root, tmp_path, settings, monkeypatch, files):
    src, table, before = str(tmp_path / "lake"), str(tmp_path / "table"), spark.conf.get(KEY)
    for feed in ("yellow", "green"):
        for p in lake.feed_paths(spark, lake_root, feed)[:4]:
            to = os.path.join(src, feed, p.split("/")[-2], os.path.basename(p))
            os.makedirs(os.path.dirname(to), exist_ok=True)
            shutil.copy2(p.removeprefix("file:"), to)
    if files:  # fewer files than a task has: rows of further ones are sorted
        monkeypatch.setattr(incremental, "unsorted_writes", partial(unsorted_writes, files=files))
    assert ingest_incremental(spark, src, table, str(tmp_path / "state")) == 8
    assert any(int(s) == (files or 64) for s in settings) and spark.conf.get(KEY) == before
    got, want = read_ingested(spark, table), lake.read_trips(spark, src)
    assert sorted(map(repr, got.drop("filename").collect())) == sorted(map(repr, want.drop("filename").collect()))
