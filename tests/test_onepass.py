"""Runs that need several results read the trips once, and the results are those of the single queries."""

import contextlib
import io
import os

from conftest import SF_SMALL
from pyspark.sql import functions as F

from cabflow.operators import cube as cb
from cabflow.operators import indicators as ind
from cabflow.operators import onepass, quantiles
from cabflow.operators import quality as qual
from cabflow.operators.normalize import valid_trips
from cabflow.operators.reconcile import reconcile_counts, reconcile_lake
from cabflow.plans import report
from cabflow.sources import lake
from cabflow.sources.fixture import fixture_trips


def rows(df, columns=None):
    return sorted(map(repr, df.select(*(columns or df.columns)).collect()))


def counted(spark, trips):
    """``trips``, and how many of its rows were ever read."""
    seen = spark.sparkContext.accumulator(0)
    return trips.mapInPandas(lambda it: (seen.add(len(p)) or p for p in it), trips.schema), seen


def test_groups_hold_what_the_single_queries_give(spark):
    trips = fixture_trips(spark, SF_SMALL)
    groups = onepass.analysis_groups(trips).cache()
    audit = onepass.audit_of(groups)
    assert rows(audit) == rows(qual.audit_by_file(trips), audit.columns)
    cube = onepass.cube_of(groups)
    direct = cb.indicator_cube(valid_trips(trips))
    few = [c for c in cube.columns if c != "tip_sum"]  # sums of quotients differ in the last bit
    assert rows(cube, few) == rows(direct, few)
    assert rows(quantiles.quantiles_of(onepass.value_counts_of(groups))) == rows(quantiles.quantiles(valid_trips(trips)))
    groups.unpersist()


def test_the_analysis_run_scans_the_trips_once(spark, tmp_path, monkeypatch):
    trips = fixture_trips(spark, SF_SMALL)
    source, seen = counted(spark, trips)
    monkeypatch.setattr(report, "read_trips", lambda *a: source)
    paths = report.run_analysis(spark, "anywhere", str(tmp_path / "out"))
    assert seen.value == trips.count()
    v = valid_trips(trips)
    single = {
        "coverage": qual.coverage(trips), "quality": qual.quality(trips), "monthly_indicators": ind.monthly_indicators(v),
        "yearly_indicators": ind.yearly_indicators_raw(v), "payment_mix": ind.payment_mix(v), "pickup_hour": ind.pickup_hour(v),
        "quantiles": quantiles.quantiles(v),
    }
    assert set(paths) == set(single)
    for name, df in single.items():
        exported = spark.read.option("header", True).schema(df.schema).csv(paths[name])
        assert rows(exported) == rows(df, exported.columns), name


def test_reconciliation_reads_the_lake_twice_at_most(spark, lake_root):
    trips = lake.read_trips(spark, lake_root)
    source, seen = counted(spark, trips)
    files = lake.read_all(spark, lake_root)
    found = reconcile_lake(source, files)
    assert found.filter(~F.col("ok")).isEmpty()
    assert seen.value == trips.count()  # all totals of the relation from one scan
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        found.explain("formatted")
    scans = {ln for ln in buf.getvalue().splitlines() if ln.startswith("ReadSchema")}
    assert scans == {"ReadSchema: struct<>"}  # and the other scan reads no column
    v = valid_trips(trips)
    direct = reconcile_counts(
        qual.coverage(trips), qual.file_row_counts(files), ind.monthly_volume(v), ind.yearly_indicators_raw(v), ind.payment_mix(v), ind.pickup_hour(v)
    )
    assert rows(found) == rows(direct)


def test_a_total_that_is_off_is_told(spark, lake_root):
    trips = lake.read_trips(spark, lake_root)
    found = reconcile_lake(trips.filter(F.col("trip_distance") != 1.0), lake.read_all(spark, lake_root))
    assert not found.filter((F.col("check") == "coverage_vs_files") & ~F.col("ok")).isEmpty()


def test_files_of_the_table_follow_bytes_and_a_hot_feed_is_split(spark, lake_root, tmp_path):
    from cabflow.plans.materialize import materialize, read_materialized, table_location

    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set(keys[1], "128k")
    spark.conf.set(keys[2], "4k")
    trips = lake.read_trips(spark, lake_root)
    hot = trips.withColumn("taxi_type", F.lit("yellow")).withColumn("file_year", F.lit(1997))

    def files(path):
        at = table_location(spark, path).removeprefix("file:")
        return {d: len([f for f in fs if f.endswith(".parquet")]) for d, _, fs in os.walk(at) if any(f.endswith(".parquet") for f in fs)}

    try:
        one = files(materialize(hot, str(tmp_path / "one")))
        assert hot.rdd.getNumPartitions() >= 10 and list(one.values()) == [1]  # many tasks, few bytes, one file
        spark.conf.set(keys[0], "64k")
        many = files(materialize(hot, str(tmp_path / "many")))
        assert len(many) == 1 and list(many.values())[0] >= 4  # and split by its bytes
        assert rows(read_materialized(spark, str(tmp_path / "many"))) == rows(read_materialized(spark, str(tmp_path / "one")))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_column_that_goes_and_returns_has_two_runs(spark):
    import json

    from cabflow.plans.ingest import schema_columns, schema_runs

    def file(month, **columns):
        signature = json.dumps({"type": "struct", "fields": [{"name": n, "type": t, "nullable": True, "metadata": {}} for n, t in columns.items()]})
        name = f"green_tripdata_2020-{month:02}.parquet"
        return ("green", 2020, name, 100, True, 5, len(columns), list(columns), signature, f"/lake/green/2020/{name}")

    files = [file(1, a="long", b="long"), file(2, a="long"), file(3, a="double", b="long"), file(5, a="long", b="long"), file(6, a="long", b="long")]
    broken = ("green", 2020, "green_tripdata_2020-04.parquet", 9, False, None, None, None, None, "/lake/x")
    schema = "taxi_type string, year int, file string, bytes long, valid_parquet boolean, rows long, columns int, column_names array<string>, signature string, path string"
    manifest = spark.createDataFrame([*files, broken], schema)
    got = sorted((r.column_name, r.type, r.first_period, r.last_period, r.periods, r.files, r.in_every_file) for r in schema_runs(manifest).collect())
    assert got == [
        ("a", "double", "2020-03", "2020-03", 1, 1, True),
        ("a", "long", "2020-01", "2020-02", 2, 2, True),
        ("a", "long", "2020-05", "2020-06", 2, 2, True),
        ("b", "long", "2020-01", "2020-01", 1, 1, True),
        ("b", "long", "2020-03", "2020-06", 3, 3, True),  # the feed has no valid file of April
    ]
    second = file(5, a="long")
    second = (*second[:2], "more_2020-05.parquet", *second[3:])
    partly = schema_runs(spark.createDataFrame([*files, second], schema)).filter("column_name = 'b' AND first_period = '2020-03'").first()
    assert (partly.files, partly.in_every_file) == (3, False)
    assert schema_columns(manifest).first().asDict() == {
        "taxi_type": "green", "year": 2020, "files": 5, "fewest_columns": 1, "most_columns": 2, "distinct_columns": 2,
    }
