"""Cross-checks between independent results."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from cabflow.operators import indicators as ind
from cabflow.operators.normalize import rejected_trips, valid_trips
from cabflow.sources.fixture import fixture_trips
from conftest import SF_SMALL


def test_valid_plus_rejected_is_raw(spark):
    t = fixture_trips(spark, SF_SMALL)
    assert valid_trips(t).count() + rejected_trips(t).count() == t.count()


def test_reconcile_all_ok(spark, lake_root):
    r = E.queries()["reconcile_counts"](spark, SF_SMALL)
    assert r.count() > 0 and r.filter(~F.col("ok")).count() == 0


def test_shares_and_quantile_order(spark):
    v = valid_trips(fixture_trips(spark, SF_SMALL))
    for r in ind.payment_share(v).groupBy("taxi_type").agg(F.sum("share_pct").alias("s")).collect():
        assert abs(r.s - 100.0) < 0.1
    q = E.queries()["quantiles_list"](spark, SF_SMALL).collect()
    for r in q:
        for m in ("distance", "duration", "total"):
            assert r[f"{m}_p50"] <= r[f"{m}_p90"] <= r[f"{m}_p99"]


def test_materialized_equals_direct(spark, lake_root):
    qs = E.queries()
    for name in ("bench_count", "bench_summary", "bench_monthly"):
        a = sorted(tuple(x) for x in qs[name](spark, SF_SMALL).collect())
        b = sorted(tuple(x) for x in qs[name + "_table"](spark, SF_SMALL).collect())  # no NULL keys here
        assert a == b, name


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 14 and set(df.columns) >= {"file_year", "taxi_type", "trips", "revenue_usd"}


def test_materialize_publishes_versions(spark, lake_root, tmp_path):
    from cabflow.plans.materialize import materialize, read_materialized, table_location
    from cabflow.sources.lake import read_trips

    path = str(tmp_path / "table")
    assert table_location(spark, path) is None
    trips = read_trips(spark, lake_root)
    for _ in range(3):
        materialize(trips, path, grace_seconds=0)
    assert read_materialized(spark, path).count() == trips.count()
    versions = [p for p in (tmp_path / "table" / "_versions").iterdir() if not p.name.startswith(".")]
    assert len(versions) == 2  # older versions pruned, the previous one kept for readers that began on it
