"""Binary fuse filters, and exact dedup against a dictionary of texts."""

import random

import numpy as np
from pyspark.sql import functions as F

from cabflow.llm import exact_dedup, fuse


def test_filters_find_all_their_keys_and_few_others():
    rng = np.random.default_rng(3)
    others = rng.integers(0, 2**64, 300_000, dtype=np.uint64)
    for n in (0, 1, 2, 7, 40, 333, 5_000, 70_000):
        keys = rng.integers(0, 2**64, n, dtype=np.uint64)
        built = fuse.build(np.r_[keys, keys[: n // 2]])
        assert fuse.contains(built, keys).all()
        assert fuse.contains(built, others).sum() < 40  # 4.6 are due
    assert len(built) * 8 / 70_000 < 20  # bits a key


def brute(rows):
    groups = {}
    for at, (i, t) in enumerate(rows):
        groups.setdefault(t or "", []).append((i is not None, i or 0, -at))
    out = []
    for own in groups.values():
        best = max(own)
        out += [(i if has else None, best[1] if best[0] else None, len(own), (has, i, at) == best) for has, i, at in own]
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).withColumn("keep_id", F.lit("other")).withColumn("digest", F.lit(1))
    out, n = exact_dedup.dedup(df, **kw)
    return sorted(((r["doc_id"], r[n["keep_id"]], r[n["group_size"]], r[n["kept"]]) for r in out.collect()), key=repr)


def rows(seed, n=400):
    rng = random.Random(seed)
    texts = ["", None, "a", "A", "a ", "ä", "ä", "x" * 300_000, "x" * 299_999 + "y"] + [f"text {i}" for i in range(90)]
    out = [(rng.choice([None, rng.randrange(10**9)]) if rng.random() < 0.1 else i, "hot" if rng.random() < 0.34 else rng.choice(texts)) for i in range(n)]
    return out + [(3, "twice"), (3, "twice"), (3, "thrice"), (None, "nobody"), (None, "nobody")]


def counts(found):
    """Of rows that are equal in key and text, any one may be kept."""
    return sorted(map(repr, found))


def test_against_a_dictionary(spark):
    for batches in (1, 2, 3):
        data = rows(batches)
        assert counts(run(spark, data, batches=batches)) == counts(brute(data))


def test_many_buckets_and_slices(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "KEYS_PER_FILTER", 8)
    monkeypatch.setattr(exact_dedup, "SLICE", 5)
    data = rows(9)
    assert counts(run(spark, data)) == counts(brute(data))


def test_texts_that_share_a_digest_are_told_apart_by_their_bytes(spark):
    data = rows(5)
    weak = lambda t: F.substring(F.unhex(F.sha2(t, 256)), 1, 1)
    for batches in (1, 2):
        assert counts(run(spark, data, digest=weak, batches=batches)) == counts(brute(data))


def test_filters_let_no_new_digest_reach_the_buckets_of_others(spark):
    """Screening drops the digests that the snapshot does not hold, whatever the texts."""
    index = exact_dedup.Index(spark)
    frame = lambda lo, hi: spark.range(lo, hi).select(exact_dedup.sha256(F.col("id").cast("string")).alias("digest"), F.col("id").cast("string").alias("text"))
    met, unequal = index.take_in(frame(0, 3000))
    assert met.isEmpty() and unequal.isEmpty()
    passed = exact_dedup._screened(frame(2900, 6000).select("digest"), 3100, index.snapshots[0])
    assert 100 <= passed.count() <= 103
    met, unequal = index.take_in(frame(2900, 6000))
    assert met.filter("equal").count() == met.count() == 100 and unequal.isEmpty()
    met, _ = index.take_in(frame(0, 6000))
    assert met.count() == 6000  # each is new in one snapshot only
    index.drop()


def test_normalised_and_empty(spark):
    df = spark.createDataFrame([(1, "Ab"), (2, "aB"), (3, "c")], "doc_id long, text string")
    out, n = exact_dedup.dedup(df, normalise=F.lower)
    assert sorted((r["doc_id"], r[n["keep_id"]]) for r in out.collect()) == [(1, 2), (2, 2), (3, 3)]
    out, n = exact_dedup.dedup(df.limit(0))
    assert out.isEmpty() and set(n) == {"keep_id", "group_size", "kept", "digest"}
    out, n = exact_dedup.dedup(df.withColumnRenamed("doc_id", "kept"), key="kept")
    assert n["kept"] != "kept" and out.count() == 3
