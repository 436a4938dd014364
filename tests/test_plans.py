"""The physical-plan properties the design relies on, asserted on executed plans."""

import contextlib
import io

import __spark_entry__ as E
from conftest import SF_SMALL


def _plan(df, run: bool = True) -> str:
    if run:
        df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _read_schemas(plan: str) -> list[str]:
    return [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")]


def test_flagship_prunes_columns(spark):
    plan = _plan(E.queries()["yearly_indicators"](spark, SF_SMALL))
    schemas = _read_schemas(plan)
    assert schemas and all("l_tax" not in s and "l_linestatus" not in s for s in schemas)
    assert "[codegen id" in plan  # whole-stage codegen in the executed plan
    assert "HashAggregate" in plan and "partial_" in plan  # map-side partial aggregation


def test_lake_scan_never_reads_unknown_columns(spark, lake_root):
    plan = _plan(E.queries()["scan_evolving_schema"](spark, SF_SMALL), run=False)
    assert "cbd_fee" not in "".join(_read_schemas(plan))


def test_table_reads_prune_partitions_and_count_from_footers(spark, lake_root):
    from cabflow import registry
    from cabflow.operators.indicators import bench_count

    count_plan = _plan(bench_count(registry._materialized(spark, SF_SMALL, (1996, 1997))))
    assert "PushedAggregation: [COUNT(*)]" in count_plan and "PartitionFilters" in count_plan
    lookup_plan = _plan(E.queries()["materialized_lookup"](spark, SF_SMALL))
    line = next(ln for ln in lookup_plan.splitlines() if ln.startswith("PartitionFilters"))
    assert "file_year" in line and "taxi_type" in line


def test_no_cartesian_or_nested_loop_joins(spark, lake_root):
    for key in ("ingest_missing_months", "reconcile_counts", "skew_check", "quantiles", "ingest_calendar"):
        plan = _plan(E.queries()[key](spark, SF_SMALL))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, key


def test_bare_count_reads_no_column_and_builds_without_a_job(spark, lake_root):
    from cabflow import registry
    from cabflow.operators.indicators import bench_count
    from cabflow.plans.benchmark import count_lake

    registry._table(spark, SF_SMALL)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "plans only")
    direct = count_lake(spark, lake_root, (1996, 1997))
    table = bench_count(registry._materialized(spark, SF_SMALL, (1996, 1997)))
    assert len(tracker.getJobIdsForGroup("build")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = _plan(direct)
    assert [s for s in _read_schemas(plan)] == ["ReadSchema: struct<>"], plan
    assert direct.first()[0] == table.first()[0]


def test_scope_puts_a_pickup_range_on_the_scan(spark, lake_root):
    from cabflow.operators.normalize import valid_trips
    from cabflow.sources import lake

    scope = (1996, 1997)
    ranged, plain = (valid_trips(lake.read_trips(spark, lake_root, scope), y) for y in (scope, None))
    plan = _plan(ranged, run=False)
    assert "GreaterThanOrEqual(tpep_pickup_datetime,1996-01-01" in plan and "LessThan(lpep_pickup_datetime,1998-01-01" in plan
    assert ranged.count() == plain.count()


def test_skew_check_scans_trips_once(spark):
    from pyspark.sql import functions as F

    from cabflow.operators import quality as qual
    from cabflow.operators.normalize import valid_trips
    from cabflow.operators.reshape import skew_check
    from cabflow.sources.fixture import fixture_trips

    trips = fixture_trips(spark, SF_SMALL)
    seen = spark.sparkContext.accumulator(0)
    counted = valid_trips(trips).mapInPandas(lambda it: (seen.add(len(p)) or p for p in it), valid_trips(trips).schema)
    skew_check(counted).collect()
    assert seen.value == valid_trips(trips).count()
    audit = qual.audit_by_file(trips)
    for one, two in ((qual.coverage_of(audit), qual.coverage(trips)), (qual.quality_of(audit), qual.quality(trips))):
        assert sorted(map(tuple, one.select(*two.columns).collect())) == sorted(map(tuple, two.collect()))
    assert audit.filter(F.col("rows") <= 0).isEmpty()
