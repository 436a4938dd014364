"""Exact duplicates of texts: binary fuse filters of immutable snapshots screen each new batch.

An ``Index`` is a list of snapshots. A snapshot never changes: its exact buckets are a table of the
distinct texts by digest, bucketed by digest, and its filters are one binary fuse filter for each
some 65,536 of its new digests (``fuse.py``). A batch is taken in like this:

1. its own duplicates are grouped separately: a row for each digest with its distinct texts
   (copies collapse inside each task before the shuffle, so a text that a third of all rows hold
   is a row a task), which become the batch's exact buckets;
2. its distinct digests are dealt to the filters' buckets, those of one bucket in as many slices
   as keep a slice bounded, each with a copy of the filter, and screened in a stream;
3. only positives are joined to the snapshot's exact buckets (both sides are bucketed alike, so no
   text is shuffled) and compared byte by byte;
4. digests that no snapshot holds are new: the filters of the new snapshot are built of them.

A class is a snapshot's entry and all that was matched to it later. Where texts that differ share a
digest, their rows are grouped by the text itself.

Defined results: null texts count as empty; the row with the largest key stays, of rows that
share it one (null keys are smallest); every row is returned, repeated ones too; an empty table
gives none. Texts of any length are compared whole. Of the input only key and text are read, and
the new columns get names that the key does not have. Digests of hot texts are counted before they
are shuffled, and the final join has two stored sides, whose hot keys Spark splits.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm import fuse
from cabflow.llm.common import fresh_name, scratch, shuffle_partitions, stored, unstore
from cabflow.session import remove

KEYS_PER_FILTER = 65_536
SLICE = 262_144  # digests that meet one copy of a filter


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def unchanged(text: Column) -> Column:
    return text


@dataclass
class Snapshot:
    """``exact``: (digest, texts), bucketed by digest; ``filters``: (bucket, filter)."""

    exact: DataFrame
    name: str
    path: str
    filters: DataFrame | None
    buckets: int


@dataclass
class Index:
    """Snapshots, oldest first; a digest is new in one of them only."""

    spark: SparkSession
    snapshots: list[Snapshot] = field(default_factory=list)

    def take_in(self, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Take in a batch (digest, text) as a snapshot of its own.

        Returns its digests that older snapshots hold, stored, as (digest, equal): whether the
        texts are the same byte by byte; and the digests that unequal texts share.
        """
        exact, name, path = _bucketed(texts.groupBy("digest").agg(F.collect_set("text").alias("texts")))
        digests = exact.select("digest")
        n = digests.count()
        met = None
        for old in self.snapshots:
            if old.filters is None or not n:
                continue
            positive = _screened(digests, n, old)
            texts_of = old.exact.withColumnRenamed("texts", "old_texts")
            pairs = positive.join(exact, "digest").join(texts_of, "digest")
            same = (F.size("texts") == 1) & (F.size("old_texts") == 1) & (F.element_at("texts", 1) == F.element_at("old_texts", 1))
            found = pairs.select("digest", same.alias("equal"))
            met = found if met is None else met.unionByName(found)
        if met is None:
            met = self.spark.createDataFrame([], "digest binary, equal boolean")
        met = stored(met, "exact-met")
        new = digests.join(met, "digest", "left_anti")
        self.snapshots.append(Snapshot(exact, name, path, *_filters(new, n)))
        unequal = exact.filter(F.size("texts") > 1).select("digest").unionByName(met.filter(~F.col("equal")).select("digest"))
        return met, unequal

    def drop(self) -> None:
        """Remove the tables of all snapshots."""
        for s in self.snapshots:
            self.spark.sql(f"DROP TABLE IF EXISTS {s.name}")
            remove(self.spark, s.path)
            if s.filters is not None:
                unstore(s.filters)
        self.snapshots.clear()


def _bucketed(df: DataFrame) -> tuple[DataFrame, str, str]:
    """``df``, which is grouped by digest, as a table bucketed by digest in the shared folder."""
    spark = df.sparkSession
    name, path = f"cabflow_exact_{uuid.uuid4().hex}", scratch(spark, "exact-buckets")
    writer = df.write.bucketBy(shuffle_partitions(spark), "digest").sortBy("digest")
    writer.option("path", path).option("compression", "zstd").saveAsTable(name, format="parquet")
    return spark.table(name), name, path


def _keys(digests: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The first 64 bits of each digest (shorter ones: filled up with 0)."""
    return np.frombuffer(b"".join(d[:8].ljust(8, b"\0") for d in digests.to_pylist()), "<u8")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket")


def _built(group: pa.Table) -> pa.Table:
    return pa.table({"bucket": group["bucket"][:1], "filter": pa.array([fuse.build(_keys(group["digest"]))], pa.binary())})


def _filters(new: DataFrame, n: int) -> tuple[DataFrame | None, int]:
    """Filters of distinct digests, at most ``n``; a group is one bucket's, evened out by hashing."""
    if not n:
        return None, 0
    buckets = math.ceil(n / KEYS_PER_FILTER)
    built = new.select(_bucket(buckets), "digest").groupBy("bucket").applyInArrow(_built, "bucket long, filter binary")
    return stored(built, "exact-filters"), buckets


def _screened(digests: DataFrame, n: int, snapshot: Snapshot) -> DataFrame:
    """Those of ``n`` distinct digests that the snapshot's filters let pass, each once."""
    slices = max(1, math.ceil(n / snapshot.buckets / SLICE))
    slice_ = F.pmod(F.xxhash64(F.lit(1), "digest"), F.lit(slices)).alias("slice")
    asked = digests.select(_bucket(snapshot.buckets), slice_, "digest", F.lit(None).cast("binary").alias("filter"))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice")
    filters = snapshot.filters.select("bucket", copies, F.lit(None).cast("binary").alias("digest"), "filter")
    parts = shuffle_partitions(digests.sparkSession)
    met = filters.unionByName(asked).repartition(parts, "bucket", "slice")
    first = F.col("digest").isNotNull()  # a slice's filter comes before its digests
    return met.sortWithinPartitions("bucket", "slice", first).mapInArrow(_pass, "digest binary")


def _pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place, built = None, b""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        where = np.stack([table["bucket"].to_numpy(), table["slice"].to_numpy()], 1)
        cuts = np.flatnonzero((np.diff(where, axis=0) != 0).any(1)) + 1
        for start, end in zip(np.r_[0, cuts], np.r_[cuts, len(where)], strict=True):
            part, here = table.slice(start, end - start), tuple(where[start]) if end > start else None
            if here is None:
                continue
            if here != place:  # a bucket without new digests has no filter, and nothing passes
                place, built = here, part["filter"][0].as_py() or b""
            asked = part["digest"].drop_null() if part["digest"].null_count else part["digest"]
            if built and len(asked):
                passed = asked.filter(pa.array(fuse.contains(built, _keys(asked))))
                yield pa.RecordBatch.from_arrays([pa.array(passed.to_pylist(), pa.binary())], names=["digest"])


def dedup(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    batches: int = 2,
    normalise: Callable[[Column], Column] = unchanged,
    digest: Callable[[Column], Column] = sha256,
) -> tuple[DataFrame, dict[str, str]]:
    """Each row's key with its class: ``keep_id``, ``group_size``, ``kept`` and the text's ``digest``; the dict has these names.

    The table is taken in as so many batches, dealt by the key's hash, each screened by the
    snapshots of those before it.
    """
    spark = docs.sparkSession
    body = normalise(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    batch = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(batches))
    read = docs.select(F.col(f"`{key}`").alias("key"), batch.alias("batch"), body.alias("text"))
    read = read.withColumn("digest", digest(F.col("text")))
    rows = stored(read.select("key", "batch", "digest", F.monotonically_increasing_id().alias("row")), "exact-rows")

    keep = F.max(F.struct("key", (-F.col("row")).alias("row"))).alias("keep")  # of equal keys the first row
    index, contributions, unequal, mets = Index(spark), [], [], []
    for b in range(batches):
        met, odd = index.take_in(read.filter(F.col("batch") == b).select("digest", "text"))
        own = rows.filter(F.col("batch") == b).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), keep)
        old = own.join(met.filter("equal").select("digest"), "digest")  # they add to an older snapshot's entry
        new = own.join(met.select("digest"), "digest", "left_anti")
        contributions += [old, new] if b else [new]
        unequal.append(odd)
        mets.append(met)
    joined = contributions[0]
    for c in contributions[1:]:
        joined = joined.unionByName(c)
    classes = stored(joined.groupBy("digest").agg(F.sum("n").alias("n"), F.max("keep").alias("keep")), "exact-classes")
    odd = unequal[0]
    for u in unequal[1:]:
        odd = odd.unionByName(u)
    odd = stored(odd.distinct(), "exact-unequal")
    index.drop()
    unstore(*mets)

    names = {n: fresh_name([key], n) for n in ("keep_id", "group_size", "kept", "digest")}

    def result(members: DataFrame) -> DataFrame:
        own = F.struct("key", (-F.col("row")).alias("row"))
        return members.select(
            F.col("key").alias(key),
            F.col("keep.key").alias(names["keep_id"]),
            F.col("n").alias(names["group_size"]),
            own.eqNullSafe(F.col("keep")).alias(names["kept"]),
            F.col("digest").alias(names["digest"]),
        )

    if odd.isEmpty():
        return result(rows.join(classes, "digest")), names
    apart = read.join(odd, "digest", "left_semi").withColumn("row", F.monotonically_increasing_id())
    apart = stored(apart.select("key", "digest", "text", "row"), "exact-apart")
    by_text = stored(apart.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n"), keep), "exact-by-text")
    even = rows.join(odd, "digest", "left_anti").join(classes, "digest")
    return result(even).unionByName(result(apart.join(by_text, ["digest", "text"]))), names
