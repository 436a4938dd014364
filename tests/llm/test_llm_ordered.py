"""The global order: rows of one key in many buckets, samples of very large tables, and neighbours across buckets."""

from pyspark.sql import functions as F

from cabflow.llm import fingerprints, ordered


def test_rows_of_one_key_fill_many_buckets(spark):
    rows = spark.range(4000).select(F.lit(7).cast("long").alias("k"), F.xxhash64("id").alias("t"))
    dealt = ordered.with_edges(rows, "k", "t").filter(F.col(ordered.EDGE) == 0)
    counts = [r["count"] for r in dealt.groupBy(ordered.BUCKET).count().collect()]
    assert sum(counts) == 4000 and max(counts) < 1000


def test_a_sample_below_a_millionth_is_not_empty(spark, monkeypatch):
    monkeypatch.setattr(ordered, "SAMPLE_PER_BUCKET", 36 / 32)
    n = ordered.BUCKETS_PER_PARTITION * ordered.shuffle_partitions(spark)
    keys = spark.range(n * 1_250_000).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("t"))
    assert len(ordered._splits(keys, "k", "t")) > n / 4


def test_next_document_of_rows_without_id(spark):
    """Rows without an id follow each other by the hash of their text, through many buckets."""
    rows = [(None, f"text number {i} of a row without id") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    ranked = [r.text for r in df.orderBy(F.xxhash64("text")).collect()]
    want = {fingerprints.edited(a, b) for a, b in zip(ranked, [*ranked[1:], ranked[0]])}
    hashes = {r[0] for r in spark.createDataFrame([(t,) for t in want], "t string").select(F.sha2("t", 256)).collect()}
    got = [r.edited_sha256 for r in fingerprints.against_next(df).collect()]
    assert len(got) == len(rows) and set(got) == hashes
