"""Ingestion that follows the lake: removed, returned and moved files, whole versions, the stream."""

import os
import shutil

import pytest

from cabflow.session import glob_paths
from cabflow.sources import lake
from cabflow.streaming import incremental, snapshots
from cabflow.streaming.incremental import ingest_incremental, ingest_stream, ledger, read_ingested


def rows(df):
    columns = [c for c in df.columns if c != "filename"]
    return sorted(map(repr, df.select(*columns).collect()))


def same(spark, src, table):
    assert rows(read_ingested(spark, table)) == rows(lake.read_trips(spark, src))


@pytest.fixture
def arrivals(spark, lake_root, tmp_path):
    src = str(tmp_path / "lake")
    paths = []
    for feed in ("yellow", "green"):
        for p in lake.feed_paths(spark, lake_root, feed)[:3]:
            p = p.removeprefix("file:")
            to = os.path.join(src, feed, p.split("/")[-2], os.path.basename(p))
            os.makedirs(os.path.dirname(to), exist_ok=True)
            shutil.copy2(p, to)
            paths.append(to)
    return src, paths, str(tmp_path / "table"), str(tmp_path / "state")


def test_a_removed_file_leaves_and_comes_back(spark, arrivals, tmp_path):
    src, files, table, state = arrivals
    assert ingest_incremental(spark, src, table, state) == 6
    same(spark, src, table)
    held = str(tmp_path / "held")
    shutil.copy2(files[1], held)
    os.remove(files[1])
    assert ingest_incremental(spark, src, table, state) == 1
    same(spark, src, table)
    assert [r.file for r in ledger(spark, state).filter("status = 'removed'").collect()] == [os.path.basename(files[1])]
    assert ingest_incremental(spark, src, table, state) == 0  # a tombstone is no news
    shutil.copy2(held, files[1])  # with the same length and time
    assert ingest_incremental(spark, src, table, state) == 1
    same(spark, src, table)
    assert ingest_incremental(spark, src, table, state) == 0


def test_a_file_that_moves_to_another_year_is_never_there_twice(spark, arrivals, monkeypatch):
    src, files, table, state = arrivals
    ingest_incremental(spark, src, table, state)
    total = read_ingested(spark, table).count()
    to = os.path.join(src, "yellow", "1999", os.path.basename(files[0]))
    os.makedirs(os.path.dirname(to))
    shutil.move(files[0], to)
    shutil.copy2(files[1], os.path.join(os.path.dirname(files[1]), "b_" + os.path.basename(files[1])))
    seen = []
    real = incremental.commit

    def watched(*a):
        out = real(*a)
        seen.append(read_ingested(spark, table).filter(f"filename LIKE '%/{os.path.basename(to)}'").count())
        return out

    monkeypatch.setattr(incremental, "commit", watched)
    assert ingest_incremental(spark, src, table, state, max_files_per_batch=1) == 3
    assert len(seen) == 2 and len(set(seen)) == 1  # after every commit the moved file's rows are there once
    same(spark, src, table)
    assert read_ingested(spark, table).count() > total


def test_years_limit_what_counts_as_removed(spark, arrivals):
    src, files, table, state = arrivals
    ingest_incremental(spark, src, table, state)
    year = int(files[0].split("/")[-2])
    os.remove(files[0])
    assert ingest_incremental(spark, src, table, state, years=(year,)) == 1
    same(spark, src, table)


def test_a_lake_without_files_is_not_believed(spark, arrivals, tmp_path):
    src, _, table, state = arrivals
    assert ingest_incremental(spark, str(tmp_path / "nothing"), table, state) == 0
    ingest_incremental(spark, src, table, state)
    with pytest.raises(FileNotFoundError):
        ingest_incremental(spark, str(tmp_path / "nothing"), table, state)
    same(spark, src, table)


def test_a_run_that_dies_before_its_commit_changes_nothing(spark, arrivals, monkeypatch):
    src, files, table, state = arrivals
    ingest_incremental(spark, src, table, state)
    before = rows(read_ingested(spark, table))
    import pyarrow.parquet as pq

    pq.write_table(pq.read_table(files[0]).slice(0, 1), files[0])
    os.remove(files[4])

    def dies(*a):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as m:
        m.setattr(incremental, "commit", dies)
        with pytest.raises(RuntimeError, match="gone"):
            ingest_incremental(spark, src, table, state)
    assert glob_paths(spark, f"{table}/batch=*/_SUCCESS")[1:]  # the new rows are written, and not read
    assert rows(read_ingested(spark, table)) == before
    with monkeypatch.context() as m:  # and if it dies while the pointer is written
        m.setattr(snapshots, "write_text", dies)
        with pytest.raises(RuntimeError, match="gone"):
            ingest_incremental(spark, src, table, state)
    snapshots._path(spark, f"{state}/versions/{2:012d}")[1].create(snapshots._path(spark, f"{state}/versions/{2:012d}")[0], False).close()
    assert rows(read_ingested(spark, table)) == before  # a pointer without content is none
    assert ingest_incremental(spark, src, table, state) == 2
    same(spark, src, table)


def test_readers_keep_the_version_they_began_on(spark, arrivals):
    src, files, table, state = arrivals
    ingest_incremental(spark, src, table, state)
    first = read_ingested(spark, table)
    before = first.count()
    os.remove(files[0])
    ingest_incremental(spark, src, table, state)
    assert first.count() == before and read_ingested(spark, table).count() < before
    old = snapshots.versions(spark, state)[0][0]
    assert read_ingested(spark, table, old).count() == before
    os.remove(files[1])
    ingest_incremental(spark, src, table, state, grace_seconds=-1)  # nobody reads old versions any more
    assert len(snapshots.versions(spark, state)) == 2
    with pytest.raises(FileNotFoundError):
        read_ingested(spark, table, old)
    named = {r.key for r in ledger(spark, state).filter("data IS NOT NULL").collect()}
    kept_before = {r.key for r in snapshots.manifest_of(spark, state, snapshots.versions(spark, state)[0][0]).filter("data IS NOT NULL").collect()}
    assert {k for _, k, _, _ in snapshots.held_parts(spark, table)} == named | kept_before
    same(spark, src, table)


def test_rows_that_are_gone_from_the_table_are_read_again(spark, arrivals):
    src, _, table, state = arrivals
    ingest_incremental(spark, src, table, state)
    _, _, folder, _ = snapshots.held_parts(spark, table)[0]
    shutil.rmtree(folder.removeprefix("file:"))
    assert ingest_incremental(spark, src, table, state) == 1
    same(spark, src, table)


def test_two_runs_from_one_version_do_not_both_commit(spark, arrivals):
    src, files, table, state = arrivals
    ingest_incremental(spark, src, table, state)
    changed = ledger(spark, state).limit(1)
    base = snapshots.versions(spark, state)[-1][0]
    snapshots.commit(spark, state, base, changed)
    with pytest.raises(RuntimeError, match="another run"):
        snapshots.commit(spark, state, base, changed)


def test_the_stream_takes_each_arrival_once_and_the_comparison_the_rest(spark, arrivals, tmp_path):
    src, files, table, state = arrivals
    held = str(tmp_path / "late.parquet")
    shutil.copy2(files[0], held)
    os.remove(files[0])
    assert ingest_stream(spark, src, table, state, max_files_per_batch=2) == 5
    same(spark, src, table)
    assert ingest_stream(spark, src, table, state) == 0
    shutil.copy2(held, files[0])
    os.utime(files[0], (1_000_000_000, 1_000_000_000))  # late, with an old time
    assert ingest_stream(spark, src, table, state) == 1
    same(spark, src, table)
    import pyarrow.parquet as pq

    pq.write_table(pq.read_table(files[2]).slice(0, 2), files[2])  # replaced under its name
    os.remove(files[3])
    assert ingest_stream(spark, src, table, state) == 2
    same(spark, src, table)
    assert ingest_stream(spark, src, table, state) == 0


def test_a_repeated_micro_batch_commits_nothing(spark, arrivals):
    src, _, table, state = arrivals
    ingest_stream(spark, src, table, state)
    number = snapshots.versions(spark, state)[-1][0]
    shutil.rmtree(f"{state}/stream")  # the stream forgets all it has done, as after a crash
    assert ingest_stream(spark, src, table, state) == 0
    assert snapshots.versions(spark, state)[-1][0] == number
    same(spark, src, table)
