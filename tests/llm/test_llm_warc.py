"""WARC archives: round trip, revisits, and the bytes themselves."""

import base64
import glob
import gzip
import hashlib
import io
import random
import zlib
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from cabflow.llm import warc
from cabflow.session import local_path


def brute(rows, least=0):
    out = []
    for i, _, p in rows:
        data = (p or "").encode()
        same = [j for j, _, q in rows if (q or "") == (p or "") and j is not None]
        top = max(same, default=None)
        again = top is not None and len(data) >= least and (i is None or i < top)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


ROWS = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (9, None, "same"), (3, "http://a/3\r\nX: y", None), (4, "u", ""), (None, "n", "same"), (None, "n", "alone"),
        (5, "u", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (6, "u", "é漢😀" * 40_000), (7, "u", "x\n"), (7, "u", "x\n"), (8, "u", "x\n")]


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, tmp_path, least):
    df = spark.createDataFrame([(*r, "extra") for r in ROWS], "page_id long, url string, html string, digest string")
    path = warc.write_archives(df, str(tmp_path / "warc"), min_bytes=least, file_bytes=2000)
    got = warc.read_archives(spark, path)
    rows = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()]
    assert sorted(rows, key=str) == brute(ROWS, least)
    assert {r.url for r in got.collect() if r.page_id == 3} == {"http://a/3%0D%0AX: y"}


def files(path):
    return [open(n, "rb").read() for n in glob.glob(f"{local_path(path)}/**/*.txt", recursive=True)]


def members(data):
    """The gzip members of a file, each decompressed by itself."""
    while data:
        one = zlib.decompressobj(wbits=31)
        text = one.decompress(data) + one.flush()
        assert one.eof
        data = one.unused_data
        yield text


def test_the_files_are_warc(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    path = warc.write_archives(df, str(tmp_path / "warc"))
    heads, by_member = [], 0
    for data in files(path):
        heads += [h for h, _ in warc.records(io.BufferedReader(io.BytesIO(gzip.decompress(data))))]
        for text in members(data):  # a record a member: each can be read by itself
            assert len(list(warc.records(io.BufferedReader(io.BytesIO(text))))) == 1
            by_member += 1
    assert len(heads) == len(ROWS) == by_member
    names = [h["warc-record-id"] for h in heads]
    assert len(set(names)) == len(names)  # repeated rows too
    for h in heads:
        assert {"warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"} <= set(h)
        assert (h["warc-type"] == "revisit") == ("warc-refers-to" in h) == ("warc-profile" in h)
        assert h.get("warc-refers-to", names[0]) in names
        assert abs(datetime.fromisoformat(h["warc-date"]) - datetime.now(timezone.utc)) < timedelta(hours=1)
    with pytest.raises(ValueError):
        list(warc.records(io.BufferedReader(io.BytesIO(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort"))))


def test_files_are_bounded_by_bytes_and_large_records_come_back(spark, tmp_path):
    rng = random.Random(1)
    noise = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=n))
    big = noise(1_000_000)
    rows = [(i, "u", f"{i}" + big[i * 1000 :] * 5) for i in range(4)]  # some 5 MB each
    rows += [(10, "u", "x" * (1 << 24)), (11, "u", "y" * ((1 << 24) + 5)), *[(20 + i, "u", noise(3000)) for i in range(200)], (10, "u", "x" * (1 << 24))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    path = warc.write_archives(df, str(tmp_path / "warc"), file_bytes=1 << 20, date=F.to_timestamp(F.lit("2020-02-03 04:05:06")))
    sizes = [len(d) for d in files(path)]
    largest = max(len(gzip.compress(t.encode())) for _, _, t in rows[:4])
    assert len(sizes) > 4 and max(sizes) < (1 << 20) + largest
    got = warc.read_archives(spark, path)
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got.collect()]
    assert sorted(found, key=str) == brute(rows)
    assert b"WARC-Date: 2020-02-03T04:05:06Z" in next(members(files(path)[0]))


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    path = warc.write_archives(df, str(tmp_path / "warc"))
    assert warc.read_archives(spark, path).isEmpty()
