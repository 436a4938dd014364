"""Session construction and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings a local run needs; on a cluster these come from the deployment.
LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Lists of up to so many single files are checked on the driver, without a job of their own.
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "1000",
    # A bare COUNT over a DataSource V2 Parquet scan comes from the footers.
    "spark.sql.parquet.aggregatePushdown": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "cabflow") -> SparkSession:
    """A session with the defaults above; ``shuffle_partitions`` is for local runs, a cluster has its own setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession, sub: str = "") -> str:
    """A folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local master may do without the setting (tests): a fresh scratch folder
    then serves as the checkpoint dir. Elsewhere a machine's own folder would be
    out of the other machines' reach, so a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="cabflow-")
        spark.sparkContext.setCheckpointDir(base)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    base = base.rstrip("/") + "/cabflow"
    return f"{base}/{sub}" if sub else base


def file_identity(spark: SparkSession, path: str) -> str:
    """``<length>-<mtime>`` of a file, to key derived data on its exact input."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    st = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p)
    return f"{st.getLen()}-{st.getModificationTime()}"


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme so Python-side helpers can open local paths."""
    if uri.startswith("file://"):
        return uri[len("file://"):] if uri.startswith("file:///") else uri[len("file:"):]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    return uri


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through its Hadoop file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def copy_folder(spark: SparkSession, source: str, target: str) -> None:
    """Copy a folder of few files from one place of a Hadoop file system to another (through the driver)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    to = b.getFileSystem(conf)
    to.mkdirs(b.getParent())
    if not jvm.org.apache.hadoop.fs.FileUtil.copy(a.getFileSystem(conf), a, to, b, False, conf):
        raise OSError(f"copy failed: {source} -> {target}")


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of the files that match (listing only, no data read)."""
    return [f[0] for f in glob_status(spark, pattern)]


_STATUS = re.compile(r"path=(.*?); isDirectory=(true|false); length=(\d+);.*?modification_time=(\d+)", re.S)


def glob_status(spark: SparkSession, pattern: str) -> list[tuple[str, int, int]]:
    """(path, length, modification time) of the files that match, sorted: three driver calls, however many they are.

    Java's own text of the whole listing crosses at once; an entry that cannot be read raises.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    if found is None:
        return []
    entries = _STATUS.findall(str(jvm.org.apache.commons.lang3.ArrayUtils.toString(found)))
    if len(entries) != len(found):
        raise ValueError(f"the listing of {pattern} has {len(found)} entries, of which {len(entries)} could be read")
    return sorted((path, int(size), int(mtime)) for path, kind, size, mtime in entries if kind == "false")


_V1_LIST = threading.RLock()  # the setting is the session's: one reader at a time changes it


@contextmanager
def parquet_v2(spark: SparkSession):
    """Resolve Parquet reads made inside the block with the DataSource V2 reader.

    V2 scans push COUNT/MIN/MAX down to footers (with
    ``spark.sql.parquet.aggregatePushdown``) and prune partitions as V1 does;
    the V1 list is restored on exit, so other reads keep ``_metadata`` support.
    """
    key = "spark.sql.sources.useV1SourceList"
    with _V1_LIST:
        old = spark.conf.get(key)
        spark.conf.set(key, ",".join(x for x in old.split(",") if x.strip().lower() != "parquet"))
        try:
            yield
        finally:
            spark.conf.set(key, old)


_OPEN: dict[str, list] = {}  # by session: how many blocks are open, and the setting before the first
_OPEN_LOCK = threading.Lock()


@contextmanager
def unsorted_writes(spark: SparkSession, files: int = 64):
    """Partitioned writes started inside the block need no sort by their partition columns.

    A task keeps up to ``files`` files open and sorts only the rows of further ones. Without
    this, every task sorts its whole share: the memory and spill of a task grow with its rows.
    Blocks may overlap: the setting, which is the session's, is restored by the last to end.
    """
    key, session = "spark.sql.maxConcurrentOutputFileWriters", spark._jsparkSession.sessionUUID()
    with _OPEN_LOCK:
        held = _OPEN.setdefault(session, [0, spark.conf.get(key)])
        held[0] += 1
        spark.conf.set(key, str(files))
    try:
        yield
    finally:
        with _OPEN_LOCK:
            held[0] -= 1
            if not held[0]:
                spark.conf.set(key, _OPEN.pop(session)[1])
