"""Versioned manifests of an ingested table, read through one atomic pointer.

A table's data folders are written once and never changed. What belongs to the
table is said by a manifest: one row for each file of the lake, with the folder
that holds its rows. Every commit writes a complete new manifest to a fresh
folder and publishes it by creating ``versions/<number>``, a file whose content
is the manifest's name; readers take the largest number that has content. So a
reader sees a whole version or the one before it, a run that dies before its
commit leaves nothing behind that is read, and of two runs that start from the
same version only one can create the next number.

Versions beyond the newest few go once they are old enough for readers that
began on them to have finished, and with them the folders that no kept version
names, also those of runs that died.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.session import glob_status, remove

# One row for each file ever seen, by ``key`` (a hash of <feed>/<year>/<file>). ``status`` is what became of
# its present version: new, failed (not valid Parquet) or removed (no longer in the lake); ``batch`` is the
# commit that found it so. ``data`` is the batch folder with its rows, null if it has none.
ENTRY = (
    "key string, path string, length long, mtime long, year int, file string, "
    "status string, batch string, data string, rows long"
)
PART = re.compile(r"/batch=([^/]+)/.*/file_key=([^/]+)/[^/]+$")


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file; raises where it is there already."""
    p, fs = _path(spark, path)
    out = fs.create(p, False)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def versions(spark: SparkSession, state: str) -> list[tuple[int, int]]:
    """(number, time in ms) of the published versions, oldest first; a marker without content was never finished."""
    found = [(int(p.rsplit("/", 1)[1]), size, t) for p, size, t in glob_status(spark, f"{state}/versions/*")]
    return sorted((n, t) for n, size, t in found if size)


def manifest_of(spark: SparkSession, state: str, version: int | None = None) -> DataFrame:
    """The manifest of a version (None: the newest); empty where nothing was committed."""
    if version is None:
        known = versions(spark, state)
        if not known:
            return spark.createDataFrame([], ENTRY)
        version = known[-1][0]
    name = read_text(spark, f"{state}/versions/{version:012d}")
    if not name:
        raise FileNotFoundError(f"version {version} of {state} was never published, or has expired")
    return spark.read.schema(ENTRY).parquet(f"{state}/manifests/{name}")


def commit(spark: SparkSession, state: str, base: int, changed: DataFrame) -> int:
    """Publish the version after ``base`` (0: none yet): its manifest with ``changed`` in place of the entries of those keys."""
    kept = manifest_of(spark, state, base) if base else spark.createDataFrame([], ENTRY)
    entries = kept.join(changed.select("key"), "key", "left_anti").select(*changed.columns).unionByName(changed)
    name = uuid.uuid4().hex
    entries.write.parquet(f"{state}/manifests/{name}")
    taken = [int(p.rsplit("/", 1)[1]) for p, _, _ in glob_status(spark, f"{state}/versions/*")]
    if (versions(spark, state) or [(0, 0)])[-1][0] != base:
        remove(spark, f"{state}/manifests/{name}")
        raise RuntimeError(f"another run has committed to {state} since version {base}")
    number = max([base, *taken]) + 1
    write_text(spark, f"{state}/versions/{number:012d}", name)  # fails if another run was faster
    return number


def held_parts(spark: SparkSession, table: str) -> list[tuple[str, str, str, int]]:
    """(data, key, folder, time in ms) of every partition folder that is in the table's folder."""
    found: dict[tuple[str, str, str], int] = {}
    for path, _, t in glob_status(spark, f"{table}/batch=*/*/*/*/file_key=*/*"):
        m = PART.search(path)
        at = (m.group(1), m.group(2), path.rsplit("/", 1)[0])
        found[at] = max(t, found.get(at, 0))
    return [(*at, t) for at, t in found.items()]


def expire(spark: SparkSession, table: str, state: str, keep: int = 2, grace_seconds: float = 6 * 3600) -> int:
    """Drop old versions and the partition folders that no version left names; returns how many folders went."""
    now = time.time() * 1000
    known = versions(spark, state)
    dropped = [n for n, t in known[:-keep] if now - t > grace_seconds * 1000]
    for n in dropped:
        name = read_text(spark, f"{state}/versions/{n:012d}")
        remove(spark, f"{state}/versions/{n:012d}")  # first the pointer: no reader can find the rest any more
        remove(spark, f"{state}/manifests/{name}")
    left = [n for n, _ in known if n not in set(dropped)]
    parts = [p for p in held_parts(spark, table) if now - p[3] > grace_seconds * 1000]
    if not parts:
        return 0
    named = None
    for n in left:
        own = manifest_of(spark, state, n).filter(F.col("data").isNotNull()).select("data", "key")
        named = own if named is None else named.unionByName(own)
    held = spark.createDataFrame(parts, "data string, key string, folder string, time long")
    stale = held if named is None else held.join(named.distinct(), ["data", "key"], "left_anti")
    folders = [r["folder"] for r in stale.select("folder").collect()]
    for folder in folders:
        remove(spark, folder)
    return len(folders)
