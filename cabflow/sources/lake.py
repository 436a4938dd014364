"""Read the raw monthly feeds ``<root>/<feed>/<year>/<feed>_tripdata_YYYY-MM.parquet``.

Files of one feed drift: columns appear, disappear, change case, and switch
between INT32, INT64 and DOUBLE. Spark's ``mergeSchema`` rejects INT64/DOUBLE
mixes and a single superset schema cannot read INT64 as double (or the
reverse), so files are grouped by their footer schema (read on executors),
groups the reader can serve with one superset schema are merged (a handful of
groups, not one per file), each group is read with its explicit schema and
projected onto the canonical columns with casts, and the groups are unioned by
name.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.operators.normalize import META_PATH, normalize_feed, union_feeds
from cabflow.session import glob_status
from cabflow.sources.catalogue import facts
from cabflow.sources.schema import FEEDS


def feed_globs(root: str, feed: str, years: tuple[int, ...] | None = None) -> list[str]:
    """The two-level wildcard, or only the listed years."""
    base = f"{root.rstrip('/')}/{feed}"
    return [f"{base}/*/*.parquet"] if years is None else [f"{base}/{y}/*.parquet" for y in years]


def feed_files(
    spark: SparkSession, root: str, feed: str, years: tuple[int, ...] | None = None
) -> list[tuple[str, int, int]]:
    """(path, length, mtime) of one feed's files; with years given, at least one has to be there."""
    files = [f for g in feed_globs(root, feed, years) for f in glob_status(spark, g)]
    if not files and years is not None:
        raise FileNotFoundError(f"no Parquet files of feed {feed!r} for years {tuple(years)} under {root}")
    return files


def feed_paths(spark: SparkSession, root: str, feed: str, years: tuple[int, ...] | None = None) -> list[str]:
    return [f[0] for f in feed_files(spark, root, feed, years)]


def require_feeds(spark: SparkSession, root: str) -> None:
    """Fail early when a feed has no file at all."""
    for feed in FEEDS:
        if not feed_files(spark, root, feed):
            raise FileNotFoundError(f"no Parquet files of feed {feed!r} under {root}")


class FileFacts(NamedTuple):
    """A file's footer: its schema as the key of its group (None: not valid Parquet), and its rows."""

    signature: str | None
    rows: int | None


# What this driver remembers of the catalogue, by (path, length, mtime), so that a query plans without
# a job; the oldest go first.
_FACTS: dict[tuple[str, int, int], FileFacts] = {}
_MAX_FACTS = 100_000


def file_facts(spark: SparkSession, files: list[tuple[str, int, int]]) -> dict[str, FileFacts]:
    """Path -> facts of its footer, from the catalogue of file versions (see ``catalogue.py``).

    A row a file comes back, in one transfer and never gathered in a task; equal
    signatures are held once.
    """
    todo = [f for f in files if f not in _FACTS]
    if todo:
        read = facts(spark.createDataFrame(todo, "path string, length long, mtime long"))
        table = read.select("path", "signature", "rows").toArrow()
        text = table["signature"].combine_chunks().dictionary_encode()
        distinct, index = text.dictionary.to_pylist(), text.indices.to_pylist()
        rows = table["rows"].to_pylist()
        found = {p: FileFacts(None if i is None else distinct[i], n) for p, i, n in zip(table["path"].to_pylist(), index, rows, strict=True)}
        for f in todo:
            _FACTS[f] = found[f[0]]
    out = {f[0]: _FACTS[f] for f in files}
    while len(_FACTS) > _MAX_FACTS:
        del _FACTS[next(iter(_FACTS))]
    return out


def signatures(spark: SparkSession, files: list[tuple[str, int, int]]) -> dict[str, str | None]:
    """Path -> footer signature (None: not valid Parquet)."""
    return {p: f.signature for p, f in file_facts(spark, files).items()}


def schema_groups(spark: SparkSession, files: list[tuple[str, int, int]]) -> dict[str, list[str]]:
    """Read schema -> files; raises where one is not valid Parquet."""
    found = signatures(spark, files)
    bad = sorted(p for p, s in found.items() if s is None)
    if bad:
        raise ValueError(f"invalid Parquet files: {', '.join(bad)}")
    exact: dict[str, list[str]] = {}
    for p, s in found.items():
        exact.setdefault(s, []).append(p)
    return merge_compatible(exact)


# Reads the Parquet reader performs for a requested type (probed on Spark 4.1):
# INT32 as BIGINT or DOUBLE and FLOAT as DOUBLE work; INT64 as DOUBLE and
# DOUBLE as BIGINT fail. A merged group requests the widest type per column.
_WIDEN = {
    frozenset({"integer", "long"}): "long",
    frozenset({"integer", "double"}): "double",
    frozenset({"float", "double"}): "double",
    frozenset({"integer", "float"}): "double",
}


def _merge(a: T.StructType, b: T.StructType) -> T.StructType | None:
    """Superset schema reading files of both ``a`` and ``b``; None on a conflict."""
    fields = {f.name.lower(): f for f in a.fields}
    for f in b.fields:
        key = f.name.lower()
        if key not in fields:
            fields[key] = f
            continue
        ta, tb = fields[key].dataType, f.dataType
        if ta == tb:
            continue
        wide = _WIDEN.get(frozenset({ta.typeName(), tb.typeName()}))
        if wide is None:
            return None
        fields[key] = T.StructField(fields[key].name, T.LongType() if wide == "long" else T.DoubleType(), True)
    return T.StructType(list(fields.values()))


def merge_compatible(exact: dict[str, list[str]]) -> dict[str, list[str]]:
    """Fold footer-schema groups into as few read schemas as the reader allows.

    Greedy, largest group first; a group joins the first merged schema it does
    not conflict with. Fewer groups mean fewer scan branches per query.
    """
    merged: list[tuple[T.StructType, list[str]]] = []
    for sig, ps in sorted(exact.items(), key=lambda kv: (-len(kv[1]), kv[0])):
        st = T.StructType.fromJson(json.loads(sig))
        for i, (cur, files) in enumerate(merged):
            both = _merge(cur, st)
            if both is not None:
                merged[i] = (both, files + ps)
                break
        else:
            merged.append((st, list(ps)))
    return {st.json(): sorted(ps) for st, ps in merged}


def read_raw_group(spark: SparkSession, paths: list[str], schema: str | None = None) -> DataFrame:
    """Files sharing one footer schema (their source path is ``_metadata.file_path``).

    ``schema`` is the group's Spark schema (JSON) from the footers; passing it
    spares Spark a schema-inference job per group and query.
    """
    reader = spark.read
    if schema:
        reader = reader.schema(T.StructType.fromJson(json.loads(schema)))
    return reader.parquet(*paths)


def read_feed(
    spark: SparkSession,
    root: str,
    feed: str,
    years: tuple[int, ...] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """One feed, normalised to the canonical 25 columns.

    ``schema`` is for stores whose footers cannot be read: all files are read with it.
    """
    files = feed_files(spark, root, feed, years)
    if not files:
        raise FileNotFoundError(f"no Parquet files of feed {feed!r} under {root}")
    if schema is not None:
        return normalize_feed(spark.read.schema(schema).parquet(*[f[0] for f in files]), feed, META_PATH)
    groups = schema_groups(spark, files)
    return union_feeds([normalize_feed(read_raw_group(spark, ps, sig), feed, META_PATH) for sig, ps in groups.items()])


def read_trips(spark: SparkSession, root: str, years: tuple[int, ...] | None = None) -> DataFrame:
    """Both feeds, UNION ALL BY NAME: the raw ``trips`` relation (optionally scoped to years)."""
    return union_feeds([read_feed(spark, root, feed, years) for feed in FEEDS])


def read_all(spark: SparkSession, root: str, years: tuple[int, ...] | None = None) -> DataFrame:
    """One scan over both feeds' files keeping only the source path.

    No data column is requested, so whatever schema each file has, the reader
    only needs row counts (a column-less Parquet scan).
    """
    return bare_rows(spark, root, years).select(F.col("_metadata.file_path").alias("filename"))


def bare_rows(spark: SparkSession, root: str, years: tuple[int, ...] | None = None) -> DataFrame:
    """All rows of both feeds without any column: what a bare COUNT needs, from row-group counts alone.

    Read by folder: a long list of single files would have Spark list them in a job.
    """
    folders = sorted({p.rsplit("/", 1)[0] for feed in FEEDS for p in feed_paths(spark, root, feed, years)})
    if not folders:
        raise FileNotFoundError(f"no Parquet files under {root}")
    return spark.read.schema(T.StructType([])).option("pathGlobFilter", "*.parquet").parquet(*folders)


def file_rows(spark: SparkSession, path: str) -> int:
    """Row count of one file (no column is read: row-group counts only)."""
    return spark.read.schema(T.StructType([])).parquet(path).count()
