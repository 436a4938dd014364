"""File layer: drifted lake, schema groups, corrupt files, scopes, incremental ingestion."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from cabflow.plans import ingest as ing
from cabflow.session import local_path
from cabflow.sources import lake
from cabflow.sources.fixture import fixture_trips
from cabflow.sources.footers import manifest
from cabflow.streaming.incremental import ingest_incremental, read_ingested
from conftest import SF_SMALL


def _sorted_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(r) for r in df.select(*cols).collect()]
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def test_drifted_lake_reads_back_equal_to_fixture(spark, lake_root):
    got = lake.read_trips(spark, lake_root).withColumn("filename", F.regexp_extract("filename", r"([^/]+)$", 1))
    first = min(r.file_year for r in got.select("file_year").distinct().collect())
    want = fixture_trips(spark, SF_SMALL)
    for c in ("airport_fee", "ehail_fee"):  # the first year's files do not carry them
        want = want.withColumn(c, F.when(F.col("file_year") != first, F.col(c)))
    assert _sorted_rows(got) == _sorted_rows(want)


def test_schema_groups_are_few_and_merged(spark, lake_root):
    m = manifest(spark, lake_root)
    assert m.select("signature").distinct().count() == 8  # 4 footer schemas per feed
    for feed in ("yellow", "green"):
        files = lake.feed_files(spark, lake_root, feed)
        groups = lake.schema_groups(spark, files)
        assert len(groups) == 2  # INT64 vs DOUBLE passenger_count is the only real conflict
        assert sum(len(v) for v in groups.values()) == len(files) == m.filter(m.taxi_type == feed).count()


def test_drift_report(spark, lake_root):
    m = manifest(spark, lake_root)
    third_year = sorted(r.year for r in m.select("year").distinct().collect())[2]
    d = {(r.taxi_type, r.column_name): r for r in ing.schema_drift(m).collect()}
    assert d[("yellow", "cbd_fee")].first_year == d[("yellow", "cbd_fee")].last_year == third_year
    assert not d[("yellow", "cbd_fee")].in_every_file
    assert d[("green", "VendorID")].in_every_file


def test_scoped_years_and_empty_scope(spark, lake_root):
    scoped = lake.read_trips(spark, lake_root, (1997,))
    assert {r.file_year for r in scoped.select("file_year").distinct().collect()} == {1997}
    with pytest.raises(FileNotFoundError):
        lake.read_trips(spark, lake_root, (2031,))


def _copy_lake(src_root, dst, n_per_feed):
    src = local_path(src_root)
    copied = []
    for feed in ("yellow", "green"):
        files = sorted(
            os.path.join(dp, f) for dp, _, fs in os.walk(os.path.join(src, feed)) for f in fs if f.endswith(".parquet")
        )
        for f in files[:n_per_feed]:
            rel = os.path.relpath(f, src)
            os.makedirs(os.path.dirname(os.path.join(dst, rel)), exist_ok=True)
            shutil.copy2(f, os.path.join(dst, rel))
            copied.append(rel)
    return copied


def test_corrupt_files_are_flagged_and_gate_fails(spark, lake_root, tmp_path):
    copied = _copy_lake(lake_root, str(tmp_path), 1)
    year = copied[0].split("/")[1]  # the bad files go into the copied files' year
    bad1 = tmp_path / "yellow" / year / f"yellow_tripdata_{year}-12.parquet"
    bad1.write_bytes(b"PAR1" + b"\x00" * 12)  # 16 bytes, no trailing magic
    bad2 = tmp_path / "green" / year / f"green_tripdata_{year}-12.parquet"
    bad2.write_bytes(b"PAR1")  # under 12 bytes
    m = manifest(spark, str(tmp_path))
    flags = {r.file: r.valid_parquet for r in m.collect()}
    assert flags[f"yellow_tripdata_{year}-12.parquet"] is False
    assert flags[f"green_tripdata_{year}-12.parquet"] is False
    assert flags[copied[0].split("/")[-1]] is True
    with pytest.raises(ValueError, match="invalid Parquet"):
        ing.gate(m)
    status = {r.status: r.files for r in ing.status_summary(ing.calendar(ing.year_span(m, "year")), m).collect()}
    assert status == {"new": 2, "failed": 2, "missing": 20, "skipped": 0}


def test_missing_months(spark, lake_root, tmp_path):
    _copy_lake(lake_root, str(tmp_path), 3)
    m = manifest(spark, str(tmp_path))
    cal = ing.calendar(ing.year_span(m, "year"))
    assert ing.missing_months(cal, m).count() == 24 - 6


def test_incremental_ingestion_is_idempotent(spark, lake_root, tmp_path):
    src = str(tmp_path / "raw")
    _copy_lake(lake_root, src, 2)
    table, ckpt = str(tmp_path / "table"), str(tmp_path / "state")
    assert ingest_incremental(spark, src, table, ckpt) == 4
    first = read_ingested(spark, table).count()
    assert ingest_incremental(spark, src, table, ckpt) == 0
    assert read_ingested(spark, table).count() == first
    _copy_lake(lake_root, src, 3)  # one more month per feed
    assert ingest_incremental(spark, src, table, ckpt) == 2
    direct = lake.read_trips(spark, src)
    assert read_ingested(spark, table).count() == direct.count()


def test_feed_presence_and_single_file_count(spark, lake_root, tmp_path):
    lake.require_feeds(spark, lake_root)
    _copy_lake(lake_root, str(tmp_path), 1)
    shutil.rmtree(tmp_path / "green")
    with pytest.raises(FileNotFoundError):
        lake.require_feeds(spark, str(tmp_path))
    path = lake.feed_paths(spark, str(tmp_path), "yellow")[0]
    rows = [r.rows for r in manifest(spark, str(tmp_path)).collect()][0]
    assert lake.file_rows(spark, path) == rows > 0


def test_analysis_and_validation_runs(spark, lake_root, tmp_path):
    from cabflow.plans.report import run_analysis, run_validation

    out = run_analysis(spark, lake_root, str(tmp_path / "results"))
    assert set(out) == {"coverage", "quality", "monthly_indicators", "yearly_indicators", "payment_mix", "pickup_hour", "quantiles"}
    cov = spark.read.option("header", True).csv(out["coverage"])
    n_years = len({r.file_year for r in cov.collect()})
    assert cov.count() == 2 * n_years and set(cov.columns) == {"taxi_type", "file_year", "files", "rows"}
    val = run_validation(spark, lake_root, str(tmp_path / "audit"))
    assert spark.read.json(val["manifest"]).count() == manifest(spark, lake_root).count()
    year = _copy_lake(lake_root, str(tmp_path / "bad"), 1)[0].split("/")[1]
    (tmp_path / "bad" / "yellow" / year / f"yellow_tripdata_{year}-12.parquet").write_bytes(b"PAR1" + b"\x00" * 12)
    with pytest.raises(ValueError, match=f"yellow_tripdata_{year}-12.parquet"):
        run_validation(spark, str(tmp_path / "bad"), str(tmp_path / "audit_bad"))
    assert spark.read.json(str(tmp_path / "audit_bad" / "manifest.json")).count() == 3  # written before failing


# --- incremental ingestion: whatever arrives, the table holds the lake's rows ---


def _ingested_equals_lake(spark, src, table):
    assert _sorted_rows(read_ingested(spark, table)) == _sorted_rows(lake.read_trips(spark, src))


def _arrivals(spark, lake_root, tmp_path, n=2):
    src = str(tmp_path / "raw")
    copied = _copy_lake(lake_root, src, n)
    return src, [os.path.join(src, c) for c in copied], str(tmp_path / "table"), str(tmp_path / "state")


def _rewrite(spark, path, keep):
    """Replace a file by its first rows."""
    import pyarrow.parquet as pq

    pq.write_table(pq.read_table(path).slice(0, keep), path)


def test_a_file_with_an_old_time_is_ingested(spark, lake_root, tmp_path):
    src, files, table, state = _arrivals(spark, lake_root, tmp_path)
    late = files.pop(0)
    held = str(tmp_path / "held.parquet")
    shutil.copy2(late, held)
    os.remove(late)
    assert ingest_incremental(spark, src, table, state) == 3
    shutil.copy2(held, late)
    os.utime(late, (1_000_000_000, 1_000_000_000))
    assert ingest_incremental(spark, src, table, state) == 1
    _ingested_equals_lake(spark, src, table)


def test_a_replaced_file_replaces_its_own_rows_only(spark, lake_root, tmp_path):
    src, files, table, state = _arrivals(spark, lake_root, tmp_path)
    ingest_incremental(spark, src, table, state)
    _rewrite(spark, files[0], 1)
    assert ingest_incremental(spark, src, table, state) == 1
    _ingested_equals_lake(spark, src, table)
    _rewrite(spark, files[0], 0)  # even by one without rows
    assert ingest_incremental(spark, src, table, state) == 1
    _ingested_equals_lake(spark, src, table)


def test_a_second_file_of_a_month_stands_beside_the_first(spark, lake_root, tmp_path):
    src, files, table, state = _arrivals(spark, lake_root, tmp_path)
    ingest_incremental(spark, src, table, state)
    shutil.copy2(files[0], os.path.join(os.path.dirname(files[0]), "part2_" + os.path.basename(files[0])))
    assert ingest_incremental(spark, src, table, state) == 1
    _ingested_equals_lake(spark, src, table)


def test_a_path_outside_the_layout_raises(spark, lake_root, tmp_path):
    src, files, table, state = _arrivals(spark, lake_root, tmp_path)
    odd = os.path.join(src, "yellow", "extra", os.path.basename(files[0]))
    os.makedirs(os.path.dirname(odd))
    shutil.copy2(files[0], odd)
    with pytest.raises(ValueError, match="layout"):
        ingest_incremental(spark, src, table, state)


def test_a_broken_file_is_rejected_and_the_rest_arrives(spark, lake_root, tmp_path):
    from cabflow.streaming.incremental import rejected_files

    src, files, table, state = _arrivals(spark, lake_root, tmp_path)
    good = open(files[0], "rb").read()
    with open(files[0], "wb") as f:  # both magics, and a footer of nonsense
        f.write(b"PAR1" + b"\x07" * 40 + (40).to_bytes(4, "little") + b"PAR1")
    assert ingest_incremental(spark, src, table, state) == 4
    assert [r.file for r in rejected_files(spark, state).collect()] == [os.path.basename(files[0])]
    assert ingest_incremental(spark, src, table, state) == 0
    with open(files[0], "wb") as f:
        f.write(good)
    assert ingest_incremental(spark, src, table, state) == 1
    _ingested_equals_lake(spark, src, table)


def test_more_batches_than_any_progress_report_holds(spark, lake_root, tmp_path):
    src, files, table, state = _arrivals(spark, lake_root, tmp_path, n=4)
    assert ingest_incremental(spark, src, table, state, max_files_per_batch=1) == 8
    from cabflow.streaming.incremental import ledger

    seen = ledger(spark, state)
    assert seen.count() == 8 and seen.select("batch").distinct().count() == 8
    _ingested_equals_lake(spark, src, table)


# --- footers ---


def test_a_broken_footer_flags_one_file(spark, lake_root, tmp_path):
    copied = _copy_lake(lake_root, str(tmp_path), 1)
    year = copied[0].split("/")[1]
    (tmp_path / "yellow" / year / f"yellow_tripdata_{year}-12.parquet").write_bytes(
        b"PAR1" + b"\x07" * 40 + (40).to_bytes(4, "little") + b"PAR1"
    )
    flags = {r.file: r.valid_parquet for r in manifest(spark, str(tmp_path)).collect()}
    assert flags.pop(f"yellow_tripdata_{year}-12.parquet") is False and all(flags.values()) and len(flags) == 2


def test_an_unreadable_store_raises(spark):
    from cabflow.sources.footers import footers

    listing = spark.createDataFrame([("nosuchstore://bucket/a.parquet", 100)], "path string, length long")
    with pytest.raises(Exception, match="nosuchstore"):
        footers(listing).collect()


def test_a_schema_of_the_callers_needs_no_footers(spark, lake_root):
    year = sorted({p.rsplit("/", 2)[1] for p in lake.feed_paths(spark, lake_root, "yellow")})[0]
    raw = spark.read.parquet(f"{lake_root}/yellow/{year}")
    given = lake.read_feed(spark, lake_root, "yellow", (int(year),), schema=raw.schema)
    assert _sorted_rows(given) == _sorted_rows(lake.read_feed(spark, lake_root, "yellow", (int(year),)))


def test_driver_calls_do_not_grow_with_the_files(spark, tmp_path, monkeypatch):
    import pyarrow as pa
    import pyarrow.parquet as pq

    first = tmp_path / "yellow" / "2024" / "yellow_tripdata_2024-01.parquet"
    os.makedirs(first.parent)
    pq.write_table(pa.table({"VendorID": pa.array([1], pa.int64())}), first)
    calls = {}
    for n in (10, 2000):
        for i in range(n):
            if not (to := first.parent / f"yellow_{i}_2024-01.parquet").exists():
                os.link(first, to)
        count = 0
        kind = type(spark.sparkContext._gateway._gateway_client)
        send = kind.send_command

        def counted(self, *a, **k):
            nonlocal count
            count += 1
            return send(self, *a, **k)

        monkeypatch.setattr(kind, "send_command", counted)
        assert len(lake.feed_files(spark, str(tmp_path), "yellow")) == n + 1
        monkeypatch.setattr(kind, "send_command", send)
        calls[n] = count
    assert calls[2000] <= calls[10] + 5


def test_all_bad_files_are_listed_in_the_report(spark, tmp_path):
    folder = tmp_path / "yellow" / "2024"
    os.makedirs(folder)
    for i in range(30):
        (folder / f"yellow_{i:02d}_2024-01.parquet").write_bytes(b"junk of some length")
    with pytest.raises(ValueError, match="30 invalid"):
        ing.gate(manifest(spark, str(tmp_path)), str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).count() == 30


def test_scoped_view_and_benchmark_exports(spark, lake_root, tmp_path):
    from cabflow.plans.benchmark import run_benchmark
    from cabflow.plans.materialize import materialize
    from cabflow.plans.views import register_scoped_view

    assert {r.file_year for r in register_scoped_view(spark, lake_root, (1997,), "trips_1997").select("file_year").distinct().collect()} == {1997}
    table = materialize(lake.read_trips(spark, lake_root), str(tmp_path / "table"))
    out = run_benchmark(spark, lake_root, table, str(tmp_path / "bench"), reps=1)
    assert spark.read.option("header", True).csv(out["benchmark"]).count() == 18
    assert spark.read.option("header", True).csv(out["benchmark_comparison"]).count() == 9
