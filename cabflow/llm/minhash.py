"""Near-duplicate documents by MinHash, with exact confirmation and connected components.

1. Every text's shingle set gets a signature of many universal hash minima and an
   order-independent 128-bit name. Texts with one set are one class, whose least
   document id stands for it; only classes go on, so copies cost no pairs.
2. Banding puts classes into buckets. Each member of a bucket is paired with the
   bucket's least class, so a bucket of n gives n - 1 pairs.
3. Pairs are verified by signature, and those left on the full sets.
4. Components of the confirmed links come from alternating large-star/small-star.
5. In a bucket whose members are in several components, members not yet compared
   may link them. Such a bucket's members meet again with their full sets, in blocks
   of a bounded number of shingles (and of like size, up to some thousands of members): the largest component's members are dealt out,
   the others sent to each block. Members outside the largest component are compared
   with all of other components, by signature and then on the sets, most alike first;
   a link joins their components at once, which spares all further pairs of these
   two. Only the links come out of a task, never the pairs. A pair that shares
   several buckets is compared in the first of them.

With 26 bands of 5 minima, two texts at a similarity of 0.85 share no bucket with a
probability of 3e-7; a signature below ``least_estimate`` rules a pair out (five
standard deviations, with the same probability). Everything else is exact.

Defined results: texts of any length are shingled whole; texts without words (null and empty ones too) have no shingles and
are linked with nothing; rows that share an id are one document, and their classes
one node; rows without an id take no part and are kept; repeated rows get equal
results; an empty table gives an empty table; columns other than id and text are
not returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.llm.common import shuffle_partitions, slices, stored, text_column, unstore
from cabflow.llm.components import connected_components
from cabflow.llm.shingles import mix, shingle_sets

BANDS, ROWS = 26, 5
BLOCK_SHINGLES = 1 << 20
EVEN_ROWS, EVEN_BLOCKS = 256, 16
_SEED = np.random.default_rng(20_000)
_A = _SEED.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _SEED.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
_NAME = np.uint64(0xD6E8FEB86659FD93)
_LONG = T.LongType()


def signature(shingles: np.ndarray, part: int = 4096) -> np.ndarray:
    """The upper halves of the least values of a*x + b over the set, one for each hash function."""
    low = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), part):
        x = shingles[at : at + part]
        low = np.minimum(low, (_A[:, None] * x + _B[:, None]).min(axis=1))
    return (low >> np.uint64(32)).astype("<u4")


def bucket_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit bucket for each band of each signature."""
    n = len(signatures)
    rows = signatures.reshape(n, BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _NAME, (n, BANDS)).copy()
    for j in range(ROWS):
        keys = mix(keys ^ rows[:, :, j])
    return keys.astype(np.int64)


def _sign(key: str, text: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            sets = shingle_sets(text_column(batch, text), size)
            names = np.zeros((len(sets), 2), np.uint64)
            for i, s in enumerate(sets):
                names[i] = mix(s).sum(dtype=np.uint64), mix(s ^ _NAME).sum(dtype=np.uint64)
            signs = [signature(s).tobytes() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index(key)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(names[:, 0].astype(np.int64)),
                    pa.array(names[:, 1].astype(np.int64)),
                    pa.array(signs, pa.binary()),
                ],
                names=[key, "n_shingles", "c1", "c2", "sig"],
            )

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    """Signatures of a binary column without nulls."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, "<u4").reshape(-1, BANDS * ROWS)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = bucket_keys(_matrix(batch.column(2)))
            cls, n = (pa.array(np.repeat(batch.column(i).to_numpy(zero_copy_only=False), BANDS)) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), cls, n], names=["bucket", "cls", "n"])


def _alike(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                same = (_matrix(batch.column(2)) == _matrix(batch.column(3))).mean(axis=1) >= least
                yield batch.filter(pa.array(same)).select([0, 1])

    return run


def _sets(key: str, text: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            raw = [s.tobytes() for s in shingle_sets(text_column(batch, text), size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(key)), pa.array(raw, pa.binary())], names=["cls", "shingles"]
            )

    return run


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [
                linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent)
                for x, y in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield batch.filter(pa.array(hits, pa.bool_())).select([0, 1])

    return run


class NearDuplicates:
    """The steps over one table of documents, with their stored tables."""

    def __init__(self, docs: DataFrame, key: str, text: str, size: int, percent: int, least_estimate: float):
        self.spark, self.key, self.text = docs.sparkSession, key, text
        self.size, self.percent, self.least = size, percent, least_estimate
        self.docs = docs.select(F.col(f"`{key}`").cast("long").alias("_id"), F.col(f"`{text}`").alias("_text"))
        schema = T.StructType(
            [T.StructField("_id", _LONG), *[T.StructField(n, _LONG) for n in ("n_shingles", "c1", "c2")], T.StructField("sig", T.BinaryType())]
        )
        self.signed = stored(self.docs.mapInArrow(_sign("_id", "_text", size), schema), "minhash-signed")
        self.classes = stored(
            self.signed.filter(F.col("_id").isNotNull() & (F.col("n_shingles") > 0))
            .groupBy("c1", "c2")
            .agg(F.min("_id").alias("cls"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig")),
            "minhash-classes",
        )
        self.pair = T.StructType([T.StructField("a", _LONG), T.StructField("b", _LONG)])

    def members(self) -> DataFrame:
        """(bucket, cls, n, hub, size) of all buckets with several classes."""
        kind = T.StructType([T.StructField(c, _LONG) for c in ("bucket", "cls", "n")])
        every = self.classes.select("cls", "n", "sig").mapInArrow(_buckets, kind)
        hubs = stored(
            every.groupBy("bucket").agg(F.min("cls").alias("hub"), F.max("cls").alias("most"), F.count(F.lit(1)).alias("size"))
            .filter(F.col("hub") < F.col("most")).drop("most"),
            "minhash-hubs",
        )
        out = stored(every.join(hubs, "bucket"), "minhash-members")
        unstore(hubs)
        return out

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) whose signatures allow a link."""
        signs = self.classes.select("cls", "sig")
        first = pairs.join(signs.select(F.col("cls").alias("a"), F.col("sig").alias("x")), "a")
        second = first.join(signs.select(F.col("cls").alias("b"), F.col("sig").alias("y")), "b")
        return stored(second.select("a", "b", "x", "y").mapInArrow(_alike(self.least), self.pair), "minhash-likely")

    def sets(self, ids: DataFrame) -> DataFrame:
        """(cls, shingles) of the classes with the given ids."""
        kind = T.StructType([T.StructField("cls", _LONG), T.StructField("shingles", T.BinaryType())])
        wanted = self.docs.join(ids.distinct(), "_id", "left_semi")
        return stored(wanted.mapInArrow(_sets("_id", "_text", self.size), kind), "minhash-sets")

    def confirmed(self, likely: DataFrame, sets: DataFrame) -> DataFrame:
        left = likely.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("x")), "a")
        full = left.join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("y")), "b")
        return stored(full.select("a", "b", "x", "y").mapInArrow(_confirm(self.percent), self.pair), "minhash-links")

    def run(self) -> DataFrame:
        members = self.members()
        crowded = members.filter(F.col("size") > 2)
        spokes = members.filter(F.col("cls") != F.col("hub")).select(F.col("hub").alias("a"), F.col("cls").alias("b"))
        likely = self.likely(spokes.distinct())
        ids = likely.select(F.col("a").alias("_id")).unionByName(likely.select(F.col("b").alias("_id")))
        sets = self.sets(ids.unionByName(crowded.select(F.col("cls").alias("_id"))))
        links = self.confirmed(likely, sets)
        done = [members, likely, sets, links]
        parts = connected_components(links)
        across = stored(self.across(crowded, parts, sets), "minhash-across")
        done += [parts, across, self.mixed]
        if not across.isEmpty():
            parts = connected_components(links.unionByName(across))
            done.append(parts)
        named = self.classes.select("c1", "c2", "cls").join(
            parts.select(F.col("node").alias("cls"), F.col("component")), "cls", "left"
        )
        named = stored(named.select("c1", "c2", F.coalesce("component", "cls").alias("component_id")), "minhash-named")
        unstore(*done, self.classes)  # the result reads the signed documents and the named classes only
        own = (F.col("n_shingles") > 0) & F.col("_id").isNotNull()
        joined = self.signed.drop("sig").withColumn("_own", own).join(named, ["c1", "c2"], "left")
        component = F.when(F.col("_own"), F.col("component_id")).otherwise(F.col("_id"))
        return joined.select(
            F.col("_id").alias(self.key),
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("_id") == component, F.lit(True)).alias("kept"),
        )

    def across(self, members: DataFrame, parts: DataFrame, sets: DataFrame) -> DataFrame:
        """Links between members of one bucket whose components differ."""
        labelled = members.select("bucket", "cls", "n", "hub").join(
            parts.select(F.col("node").alias("cls"), "component"), "cls", "left"
        ).withColumn("component", F.coalesce("component", "cls"))
        counts = labelled.groupBy("bucket", "component").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows"))
        mixed = self.mixed = stored(
            counts.groupBy("bucket").agg(
                F.sum("n").alias("all"), F.max("n").alias("top"),
                F.max_by("component", F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("parts"),
                F.sum("rows").alias("all_rows"), F.max_by("rows", F.struct("n", "component")).alias("top_rows"),
            ).filter(F.col("parts") > 1),
            "minhash-mixed",
        )

        def blocks(shingles: Column, rows: Column) -> Column:
            """As many as memory asks for, and up to ``EVEN_BLOCKS`` so that tasks get blocks of like size."""
            even = F.least(F.ceil(rows / EVEN_ROWS), F.lit(EVEN_BLOCKS))
            return F.greatest(F.ceil(shingles / BLOCK_SHINGLES), even).cast("long")

        blocks_main = blocks(F.col("top"), F.col("top_rows"))
        blocks_rest = blocks(F.col("all") - F.col("top"), F.col("all_rows") - F.col("top_rows"))
        dealt = lambda n: F.pmod(F.xxhash64("cls"), n)
        is_main = F.col("component") == F.col("main")
        span = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
        here = dealt(blocks_rest)
        main_places = F.transform(span(blocks_rest), lambda j: F.struct(dealt(blocks_main).alias("i"), j.alias("j")))
        rest_places = F.concat(
            F.transform(span(blocks_main), lambda i: F.struct(i.alias("i"), here.alias("j"))),
            F.transform(
                F.filter(span(blocks_rest), lambda j: j != here),
                lambda j: F.struct((-1 - F.least(j, here)).alias("i"), F.greatest(j, here).alias("j")),
            ),
        )
        rows = labelled.join(mixed, "bucket").withColumn("at", F.explode(F.when(is_main, main_places).otherwise(rest_places)))
        placed = rows.select("bucket", F.col("at.i").alias("i"), F.col("at.j").alias("j"), "cls", "component", "main", "hub")
        whole = placed.join(self.classes.select("cls", "sig"), "cls").join(sets, "cls")
        spread = whole.repartition(shuffle_partitions(self.spark), "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
        return spread.mapInArrow(_join_components(self.least, self.percent), self.pair)


def _join_components(least: float, percent: int):
    def links(group: pa.Table) -> Iterator[tuple[int, int]]:
        cls, part, hub = (group[c].to_numpy() for c in ("cls", "component", "hub"))
        main = int(group["main"][0].as_py())
        signs = _matrix(group["sig"].combine_chunks())
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in group["shingles"]]
        sizes = np.array([len(x) for x in sets])
        bands = signs.reshape(len(signs), BANDS, ROWS)
        mine = int(np.flatnonzero(bucket_keys(signs[:1])[0] == group["bucket"][0].as_py())[0])
        label = np.unique(part, return_inverse=True)[1]  # components; a link makes two labels one
        rest = np.flatnonzero(part != main)
        for u in rest:
            open_ = label != label[u]
            # Pairs outside the largest component come up from both sides, and the hub's were the first of all.
            open_[(part != main) & (np.arange(len(cls)) < u)] = False
            open_ &= (cls != hub) & (cls[u] != hub[u])
            open_ &= 100 * np.minimum(sizes, sizes[u]) >= percent * np.maximum(sizes, sizes[u])
            at = np.flatnonzero(open_)
            if not len(at):
                continue
            same = bands[at] == bands[u]
            share = same.mean(axis=(1, 2))
            earlier = same[:, :mine].all(axis=2).any(axis=1)
            hits = np.flatnonzero((share >= least) & ~earlier)
            for k in hits[np.argsort(-share[hits], kind="stable")]:
                v = at[k]
                if label[v] != label[u] and linked(sets[u], sets[v], percent):
                    yield int(cls[u]), int(cls[v])
                    label[label == label[v]] = label[u]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["bucket", "i", "j"]):
            found = list(links(group))
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal integer keys in a sorted stream, each of them whole."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys], 1)
        cuts = np.flatnonzero((columns[1:] != columns[:-1]).any(axis=1)) + 1
        for start, end in zip(np.r_[0, cuts], np.r_[cuts, len(columns)], strict=True):
            now = tuple(columns[start])
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = 5,
    percent: int = 80,
    least_estimate: float | None = None,
) -> DataFrame:
    """(key, n_shingles, component_id, kept): documents linked at a similarity of ``percent`` or more, in components.

    Below 80 percent the bands no longer find nearly all links, so less is refused.
    """
    if percent < 80:
        raise ValueError("the bands are made for 80 percent or more")
    least = percent / 100 - 5 * (percent / 100 * (1 - percent / 100) / (BANDS * ROWS)) ** 0.5 if least_estimate is None else least_estimate
    return NearDuplicates(docs, key, text, size, percent, least).run()
