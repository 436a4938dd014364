"""WARC archives of pages with revisit records, written and read on the cluster.

``resolve`` shuffles the pages' headers (no payload) by payload digest and gives each
group of equal payloads its original, the record with the largest id; only groups of
several records go on. ``write_archives`` joins these to the pages and writes one record
a row with fresh headers: responses with their payload, revisits with a pointer to the
original only. Each record is a gzip member of its own, so that a reader can start at
any of them, and a file ends after ``file_bytes`` of members, whatever their number.

Spark's text writer commits the files, in any store: a row is a member without its last
byte, and that byte is the line separator. It is 0, being the highest of the member's
32-bit length; a record of 16 MB or more is followed by an empty member, which ends in 0.

``read_archives`` streams each file once, record by record by Content-Length, takes a
response's digest and length from the payload it reads, and joins the revisits to the
responses they refer to.

Defined results: a null payload is empty, one of any length is written whole; a null id is
below all others, and records of a group without any id are all responses, as are repeated
rows with a group's largest id (each has a record id of its own; revisits refer to one of
them); line breaks in a URL are percent-encoded; an empty table gives an empty archive; other
columns of the pages, whatever their names, are not archived.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.llm.common import slices, stored, text_column, unstore

FILE_BYTES = 64 << 20
# The record terminator, and the profile of a revisit with identical payload, of WARC 1.1.
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# The digits of base 32 in Java's number format and in RFC 4648.
JAVA_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
RFC_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 as bare upper-case base 32: five hexadecimal digits are four of base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*parts)), JAVA_DIGITS, RFC_DIGITS)


def headers(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit(""))
    return pages.select(
        F.col(f"`{key}`").cast("long").alias("id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        F.octet_length(body).cast("long").alias("bytes"),
        base32_sha1(body.cast("binary")).alias("digest"),
        body.alias("body"),
    )


def resolve(heads: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(digest, original): the largest id of each payload of at least ``min_bytes`` that several records have."""
    groups = heads.filter(F.col("bytes") >= min_bytes).groupBy("digest")
    return groups.agg(F.max("id").alias("original"), F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).drop("_n")


def _record_id(key: Column, digest: Column, copy: Column) -> Column:
    """A name made of id, payload and, for rows that are equal in both, the row's number (null: the first of them)."""
    h = F.md5(F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("-")), digest, copy.cast("string")))
    cut = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cut]), F.lit(">"))


def _told_apart(heads: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``heads`` with ``copy``: null but for rows that repeat an earlier one's id and payload; and the tables it reads."""
    none = F.lit(None).cast("long").alias("copy")
    repeats = stored(heads.groupBy("id", "digest").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).drop("_n"), "warc-repeats")
    if repeats.isEmpty():
        return heads.select("*", none), [repeats]
    other = repeats.select(F.col("id").alias("_id"), F.col("digest").alias("_digest"))
    same = heads["id"].eqNullSafe(other["_id"]) & (heads["digest"] == other["_digest"])
    rows = stored(heads.join(other, same, "left_semi").withColumn("_row", F.monotonically_increasing_id()), "warc-repeated")
    least = stored(rows.groupBy("id", "digest").agg(F.min("_row").alias("_first")), "warc-first")
    first = least.select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), "_first")
    numbered = rows.join(first, rows["id"].eqNullSafe(first["_id"]) & (rows["digest"] == first["_digest"]))
    numbered = numbered.withColumn("copy", F.when(F.col("_row") != F.col("_first"), F.col("_row")))
    single = heads.join(other, same, "left_anti").select("*", none)
    return single.unionByName(numbered.select(*single.columns)), [repeats, rows, least]


def _members(file_bytes: int):
    """Each record as a gzip member without its last byte, which is 0, and the number of its file."""
    empty = gzip.compress(b"", mtime=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number, size = (task.partitionId() if task else 0) << 32, 0
        for batch in slices(batches, "value"):
            out, files = [], []
            for record in text_column(batch, "value").cast(pa.binary()):
                data = gzip.compress(record.as_py() + RECORD_END.encode(), 6, mtime=0)
                data += empty if data[-1] else b""
                if size and size + len(data) > file_bytes:
                    number, size = number + 1, 0
                size += len(data)
                out.append(data[:-1])
                files.append(number)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(files, pa.int64())], names=["value", "file"])

    return run


def write_archives(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_bytes: int = 0,
    date: Column | None = None,
    file_bytes: int = FILE_BYTES,
) -> str:
    """Write one record for each page under ``path``; ``date`` (a timestamp; default: now) is the record's WARC-Date."""
    heads = headers(pages, key, url, payload).withColumn("date", F.current_timestamp() if date is None else date)
    # A table of its own: a group of copies may be huge, and only a join of two plain sides is split.
    originals = stored(resolve(heads.select("id", "bytes", "digest"), min_bytes), "warc-originals")
    named, used = _told_apart(heads)
    found = named.join(originals, "digest", "left")
    again = F.col("original").isNotNull() & (F.col("bytes") >= min_bytes) & (
        F.col("id").isNull() | (F.col("id") < F.col("original"))
    )
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    target = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    is_again = F.col("again")
    when = F.date_format(F.to_utc_timestamp("date", F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(is_again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _record_id(F.col("id"), F.col("digest"), F.col("copy"))),
        line("WARC-Date", when),
        F.coalesce(line("WARC-Target-URI", target), F.lit("")),
        F.coalesce(line("X-Record-Key", F.col("id").cast("string")), F.lit("")),
        F.when(is_again, F.concat(
            line("WARC-Profile", F.lit(REVISIT_PROFILE)),
            line("WARC-Refers-To", _record_id(F.col("original"), F.col("digest"), F.lit(None))),
        )).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", (F.octet_length("http") + F.when(is_again, F.lit(0)).otherwise(F.col("bytes"))).cast("string")),
        F.lit("\r\n"),
        F.col("http"),
        F.when(is_again, F.lit("")).otherwise(F.col("body")),
    )
    rows = found.withColumn("again", again).withColumn("http", http).select(record.alias("value"))
    members = rows.mapInArrow(_members(file_bytes), "value binary, file long")
    members.select(F.col("value").cast("string").alias("value"), "file").write.partitionBy("file").option("lineSep", "\0").text(path)
    unstore(originals, *used)
    return path


RECORD = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("refers_to_record", T.StringType()),
        T.StructField("stated_digest", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
    ]
)


def records(data: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a stream; raises on a damaged one."""
    while first := data.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {first[:40]!r}")
        head = {}
        while (row := data.readline().rstrip(b"\r\n")):
            name, _, value = row.partition(b":")
            head[name.decode().lower()] = value.strip().decode()
        size = int(head["content-length"])
        block = data.read(size)
        if len(block) != size or data.read(4) != RECORD_END.encode():
            raise ValueError(f"record {head.get('warc-record-id')} is cut short")
        yield head, block


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = RECORD.fieldNames()
    for batch in batches:
        for content in batch.column(0):
            rows = []
            with gzip.GzipFile(fileobj=io.BytesIO(content.as_py())) as data:
                for head, block in records(io.BufferedReader(data, 1 << 20)):
                    kind, key = head["warc-type"], head.get("x-record-key")
                    stated = head["warc-payload-digest"].removeprefix("sha1:")
                    size = digest = None
                    if kind == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        size = len(payload)
                        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if digest != stated:
                            raise ValueError(f"record {head['warc-record-id']}: payload and digest differ")
                    rows.append((int(key) if key else None, head.get("warc-target-uri"), kind, head["warc-record-id"],
                                 head.get("warc-refers-to"), stated, digest, size))
            if rows:
                kinds = [pa.int64(), *[pa.string()] * 6, pa.int64()]
                columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records under ``path``, revisits with the length and digest of the payload of their original."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    found = stored(files.mapInArrow(_parse, RECORD), "warc-records")  # read once, for both sides of the join
    responses = found.filter(F.col("record_type") == "response").select(
        F.col("record_id").alias("refers_to_record"),
        F.col("page_id").alias("refers_to"),
        F.col("payload_digest").alias("_digest"),
        F.col("payload_bytes").alias("_bytes"),
    )
    return found.join(responses, "refers_to_record", "left").select(
        "page_id",
        "url",
        "record_type",
        "record_id",
        "refers_to",
        F.coalesce("payload_digest", "_digest").alias("payload_digest"),
        F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"),
    )
