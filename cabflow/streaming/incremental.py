"""Incremental ingestion that follows the lake: new, replaced, returned and removed monthly files.

A run compares three things: the lake's listing, the ledger (the manifest of the
newest version, see ``snapshots.py``) and the partition folders that the table
holds. A file that the ledger does not have, or has with another length or time,
is read again, and so is one whose rows are gone from the table's folder; a file
that is no longer listed becomes a tombstone, and its rows leave the table. Files
are told apart by <feed>/<year>/<file>, so a file that moves to another year is
removed there and arrives here.

New files are read in batches of a bounded number with the schema-group reader
(drift-tolerant), normalised, and written to a fresh folder, partitioned by
(file_year, taxi_type, file_month, file_key), without a sort. Then one commit publishes the next
version. Nothing that a version names is ever written again or deleted while it
can be read, so a reader sees whole versions only, before, during and after a
run, and a run that dies is repeated from its last commit. Tombstones are
published with the last batch, together with those arrivals that look like moved
files, so that no version has a moved file twice or not at all.

Files that are not valid Parquet go to the ledger as ``failed``, with no rows
(those of an earlier, good version stay), and are tried again when they change. A
path outside the lake's layout raises, and so does a lake without any file while
the table has some (a store that is not mounted looks like that).

``ingest_stream`` is the same as a stream: a file source finds the arrivals, and
each micro-batch goes to the same commits. A source knows files by path alone, so
replaced and removed ones are found by the comparison that ends the run.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.operators.normalize import META_PATH, normalize_feed, union_feeds
from cabflow.session import unsorted_writes
from cabflow.sources.footers import LAKE_LAYOUT
from cabflow.sources.lake import feed_files, file_facts, merge_compatible, read_raw_group
from cabflow.sources.schema import CANONICAL_NAMES, FEEDS, canonical_schema
from cabflow.streaming.snapshots import (
    ENTRY,
    commit,
    expire,
    held_parts,
    manifest_of,
    read_text,
    versions,
    write_text,
)

TABLE_PARTITIONS = ("file_year", "taxi_type", "file_month", "file_key")
LISTING = "key string, path string, length long, mtime long, year int, file string"
File = tuple[str, int, int]  # path, length, modification time in ms


def _key(path: Column) -> Column:
    """<feed>/<year>/<file> of a path, hashed: the same for any spelling of the root."""
    return F.md5(F.concat_ws("/", *[F.regexp_extract(path, LAKE_LAYOUT, i) for i in (1, 2, 3)]))


def ledger(spark: SparkSession, state: str) -> DataFrame:
    """Every file seen so far and what became of its present version (see ``snapshots.ENTRY``)."""
    return manifest_of(spark, state)


def rejected_files(spark: SparkSession, state: str) -> DataFrame:
    """Files whose present version is not valid Parquet."""
    return ledger(spark, state).filter(F.col("status") == "failed").select("path", "file", "length", "mtime")


def _listed(files: Iterable[File]) -> list[tuple]:
    rows = []
    for path, length, mtime in files:
        m = re.search(LAKE_LAYOUT, path)
        if not m:
            raise ValueError(f"not in the layout <feed>/<year>/<file>: {path}")
        rows.append((hashlib.md5("/".join(m.groups()).encode()).hexdigest(), path, length, mtime, int(m.group(2)), m.group(3)))
    return rows


def difference(
    spark: SparkSession, listing: list[tuple], table: str, state: str, years: tuple[int, ...] | None = None, whole: bool = True
) -> DataFrame:
    """Files whose state changed: their listed and known columns and ``change``.

    ``change`` is arrived, replaced, lost (its rows are gone from the table) or, where the
    listing is the ``whole`` one of the ``years``, removed.
    """
    known = ledger(spark, state).select(
        "key", *[F.col(c).alias(f"old_{c}") for c in ("path", "length", "mtime", "year", "file", "status", "data", "rows")]
    )
    if years is not None:
        known = known.filter(F.col("old_year").isin(*years))
    parts = [(data, key, True) for data, key, _, _ in held_parts(spark, table)]
    held = spark.createDataFrame(parts, "old_data string, key string, held boolean").distinct()
    files = spark.createDataFrame(listing, LISTING)
    same = (F.col("length") == F.col("old_length")) & (F.col("mtime") == F.col("old_mtime"))
    lost = F.col("old_data").isNotNull() & (F.col("old_rows") > 0) & F.col("held").isNull()
    change = (
        F.when(F.col("path").isNull(), F.when((F.col("old_status") != "removed") & F.lit(whole), "removed"))
        .when(F.col("old_status").isNull() | (F.col("old_status") == "removed"), "arrived")
        .when(~same, "replaced")
        .when(lost, "lost")
    )
    joined = files.join(known, "key", "full_outer").join(held, ["key", "old_data"], "left")
    return joined.withColumn("change", change).filter(F.col("change").isNotNull())


def _write_rows(spark: SparkSession, found: dict[str, str], feeds: dict[str, str], folder: str) -> None:
    frames = []
    for feed in FEEDS:
        exact: dict[str, list[str]] = {}
        for path, signature in found.items():
            if feeds[path] == feed:
                exact.setdefault(signature, []).append(path)
        frames += [normalize_feed(read_raw_group(spark, ps, sig), feed, META_PATH) for sig, ps in merge_compatible(exact).items()]
    rows = union_feeds(frames).withColumn("file_key", _key(F.col("filename")))
    with unsorted_writes(spark):  # a task reads file after file, few in all, and each is a partition of the table
        rows.write.partitionBy(*TABLE_PARTITIONS).parquet(folder)


def _stage(spark: SparkSession, changes: list, table: str) -> list[tuple]:
    """Write the rows of a bounded number of files to a fresh folder; returns their ledger entries."""
    batch = uuid.uuid4().hex
    facts = file_facts(spark, [(r["path"], r["length"], r["mtime"]) for r in changes])
    good = {p: f.signature for p, f in facts.items() if f.signature is not None}
    if good:
        _write_rows(spark, good, {p: re.search(LAKE_LAYOUT, p).group(1) for p in good}, f"{table}/batch={batch}")
    out = []
    for r in changes:
        ok = r["path"] in good
        known = (batch, facts[r["path"]].rows) if ok else (r["old_data"], r["old_rows"])  # a good version's rows stay
        out.append((r["key"], r["path"], r["length"], r["mtime"], r["year"], r["file"], "new" if ok else "failed", batch, *known))
    return out


def _take(spark: SparkSession, changes: list, table: str, state: str, size: int) -> int:
    """Commit the changes, ``size`` files at a time; tombstones and moved files go together, last."""
    gone = [r for r in changes if r["change"] == "removed"]
    left = {(r["old_file"], r["old_length"]) for r in gone}
    moved = [r for r in changes if r["change"] != "removed" and (r["file"], r["length"]) in left]
    plain = [r for r in changes if r["change"] != "removed" and (r["file"], r["length"]) not in left]
    base = (versions(spark, state) or [(0, 0)])[-1][0]

    def publish(entries: list[tuple]) -> None:
        nonlocal base
        base = commit(spark, state, base, spark.createDataFrame(entries, ENTRY))

    for at in range(0, len(plain), size):
        publish(_stage(spark, plain[at : at + size], table))
    if gone:
        batch = uuid.uuid4().hex
        last = [
            (r["key"], r["old_path"], r["old_length"], r["old_mtime"], r["old_year"], r["old_file"], "removed", batch, None, None)
            for r in gone
        ]
        for at in range(0, len(moved), size):
            last += _stage(spark, moved[at : at + size], table)
        publish(last)
    return len(changes)


def _name_state(spark: SparkSession, table: str, state: str) -> None:
    """The table's folder names the folder of its manifests."""
    known = read_text(spark, f"{table}/_state")
    if known is None:
        write_text(spark, f"{table}/_state", state)
    elif known != state:
        raise ValueError(f"{table} has its manifests in {known}, not in {state}")


def ingest_incremental(
    spark: SparkSession,
    root: str,
    table: str,
    state: str,
    max_files_per_batch: int = 500,
    years: tuple[int, ...] | None = None,
    grace_seconds: float = 6 * 3600,
) -> int:
    """Make ``table`` follow the files under ``root``; returns how many file versions the ledger gained.

    ``state`` is the folder of the manifests; ``years`` limits the run to these years' folders;
    versions that are superseded stay readable for ``grace_seconds``.
    """
    _name_state(spark, table, state)
    listing = _listed(f for feed in FEEDS for f in feed_files(spark, root, feed, years))
    if not listing:
        if not ledger(spark, state).filter(F.col("status") != "removed").isEmpty():
            raise FileNotFoundError(f"no Parquet file under {root}, of which the table has some")
        return 0
    changed = difference(spark, listing, table, state, years).orderBy("path", "old_path").collect()  # a short row a file
    taken = _take(spark, changed, table, state, max_files_per_batch)
    expire(spark, table, state, grace_seconds=grace_seconds)
    return taken


# Columns of Spark's binaryFile source.
_FILE_SOURCE = "path string, modificationTime timestamp, length long, content binary"


def ingest_stream(
    spark: SparkSession, root: str, table: str, state: str, max_files_per_batch: int = 500, grace_seconds: float = 6 * 3600
) -> int:
    """``ingest_incremental`` as a stream that takes what has arrived and stops; returns how many versions the ledger gained.

    The stream's checkpoint is in ``state``. A micro-batch that is repeated after a crash finds
    its files in the ledger and commits nothing.
    """
    _name_state(spark, table, state)
    gained = 0

    def take(arrivals: DataFrame, _: int) -> None:
        nonlocal gained
        own = arrivals.sparkSession
        files = [tuple(r) for r in arrivals.collect()]  # at most max_files_per_batch short rows
        changed = difference(own, _listed(files), table, state, whole=False).orderBy("path").collect()
        gained += _take(own, changed, table, state, max_files_per_batch)

    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SOURCE)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", max_files_per_batch)
        .option("maxFileAge", "36500d")  # late files may carry old times
        .option("ignoreMissingFiles", "true")
        .load(f"{root.rstrip('/')}/{{{','.join(FEEDS)}}}/*")
        .select("path", "length", F.unix_millis("modificationTime").alias("mtime"))  # contents are not read
    )
    query = (
        arrivals.writeStream.foreachBatch(take)
        .option("checkpointLocation", f"{state}/stream")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return gained + ingest_incremental(spark, root, table, state, max_files_per_batch, grace_seconds=grace_seconds)


def read_ingested(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The ingested table in canonical column order, as of ``version`` (None: the newest).

    A batch all of whose files still count is read as one folder, any other by the folders of
    those that do.
    """
    state = read_text(spark, f"{table}/_state")
    if state is None:
        raise FileNotFoundError(f"nothing was ingested into {table}")
    schema = T.StructType([*canonical_schema().fields, T.StructField("file_key", T.StringType()), T.StructField("batch", T.StringType())])
    entries = manifest_of(spark, state, version).filter(F.col("data").isNotNull() & (F.col("rows") > 0))
    held: dict[str, set[str]] = {}
    for data, key, _, _ in held_parts(spark, table):
        held.setdefault(data, set()).add(key)
    live = entries.groupBy("data").agg(F.collect_list("key").alias("keys")).collect()  # a short key a file, as any list of files
    paths = []
    for data, keys in sorted(map(tuple, live)):
        whole = held.get(data, set()) <= set(keys)
        paths.append(f"{table}/batch={data}" + ("" if whole else f"/*/*/*/file_key={{{','.join(sorted(keys))}}}"))
    if not paths:
        return spark.createDataFrame([], schema).select(*CANONICAL_NAMES)
    return spark.read.schema(schema).option("basePath", table).parquet(*paths).select(*[F.col(c) for c in CANONICAL_NAMES])
