"""Footer facts are read once for each file version, whatever the session."""

import os
import shutil
import uuid

from cabflow.sources import catalogue, lake
from cabflow.sources import footers as ft


def _copies(spark, lake_root, tmp_path, n=3):
    paths = []
    for p in lake.feed_paths(spark, lake_root, "yellow")[:n]:
        p = p.removeprefix("file:")
        to = tmp_path / "lake" / "yellow" / p.split("/")[-2] / os.path.basename(p)
        os.makedirs(to.parent, exist_ok=True)
        shutil.copy2(p, to)
        paths.append(str(to))
    return str(tmp_path / "lake"), paths


def _opened(monkeypatch, then):
    """How many footers ``then()`` opens."""
    opened = []
    real = ft.footers

    def counted(listing):
        opened.extend(r["path"] for r in listing.select("path").collect())
        return real(listing)

    with monkeypatch.context() as m:
        m.setattr(ft, "footers", counted)
        then()
    return len(opened)


def test_a_second_session_opens_no_footer_of_an_unchanged_file(spark, lake_root, tmp_path, monkeypatch):
    src, paths = _copies(spark, lake_root, tmp_path)

    def read():
        lake._FACTS.clear()  # what a session's driver remembers
        files = lake.feed_files(spark, src, "yellow")
        assert set(lake.signatures(spark, files)) == {f[0] for f in files}

    assert _opened(monkeypatch, read) == 3
    assert _opened(monkeypatch, read) == 0
    assert _opened(monkeypatch, lambda: ft.manifest(spark, src).collect()) == 0  # the manifest uses the same table
    import pyarrow.parquet as pq

    pq.write_table(pq.read_table(paths[0]).slice(0, 1), paths[0])
    assert _opened(monkeypatch, read) == 1
    assert {r.file: r.rows for r in ft.manifest(spark, src).collect()}[os.path.basename(paths[0])] == 1


def test_facts_equal_the_footers_and_broken_files_are_kept_as_such(spark, lake_root, tmp_path):
    src, paths = _copies(spark, lake_root, tmp_path)
    with open(paths[1], "wb") as f:
        f.write(b"no Parquet file at all")
    listing = ft.list_files(spark, src)
    direct = {r["path"]: (r["valid_parquet"], r["rows"], r["signature"]) for r in ft.footers(listing.select("path", "length")).collect()}
    for _ in range(2):
        assert {r["path"]: (r["valid_parquet"], r["rows"], r["signature"]) for r in catalogue.facts(listing).collect()} == direct
    assert sorted(v[0] for v in direct.values()) == [False, True, True]


def test_what_two_sessions_add_at_once_counts_once(spark, lake_root, tmp_path):
    src, _ = _copies(spark, lake_root, tmp_path)
    listing = ft.list_files(spark, src)
    assert catalogue.facts(listing).count() == 3
    held = catalogue.known(spark).join(listing, catalogue.VERSION, "left_semi")
    held.write.parquet(catalogue.work_dir(spark, f"footers/{uuid.uuid4().hex}"))
    assert catalogue.facts(listing).count() == 3
    assert catalogue.facts(listing.limit(0)).isEmpty()
