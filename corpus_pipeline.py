"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Every stage takes any documents: null ids and texts, empty and very long texts, repeated rows, and
empty tables (which stay empty); columns it does not know pass through all stages but the last,
whatever their names, as each stage gives its own columns names that are not taken. What a stage
does with them is said at the stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm import line_dedup, minhash, packing, quality
from cabflow.llm.common import fresh_name, stored
from cabflow.llm.queries import quality_model
from cabflow.llm.tokens import public_path

QUALITY_THRESHOLD = 0.3


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that score below the threshold go.

    Null and empty texts are scored as empty; rows that share an id or a text are scored each
    for itself; a null id is never a trusted row; without a label all score 0.5 and stay.
    """
    name = fresh_name(docs.columns, "score")
    scored = quality.score(docs, quality_model(spark, docs, sf_dir), out=name)
    return scored.filter(F.col(name) >= QUALITY_THRESHOLD).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines of at least 40 code points in at least 5 documents stay in the last one only.

    The last document is that with the largest id; rows that share an id are one document, a null
    id is before all others. Documents that lose no line keep their text and ``n_chars`` as they
    are, null too.
    """
    out, new = line_dedup.dedup_lines(docs)
    text = F.col(new["kept"])
    changed = {"text": text, "n_chars": F.char_length(text).cast("long")}
    lost = F.col(new["n_dropped"]) > 0
    return out.select(*[F.when(lost, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else c for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup at a similarity of 0.8: the document with the least id of each group stays.

    Documents without an id or without words are linked with nothing and stay. Rows that share an
    id are one document: that with the least hash of its text stays, then that with the least hash
    of all columns; of rows that are equal in all, one.
    """
    groups = minhash.near_duplicates(docs, percent=80)
    kept = groups.filter("kept").select("doc_id").filter(F.col("doc_id").isNotNull()).distinct()
    hashes = {n: fresh_name(docs.columns, n) for n in ("_text", "_all", "_first")}
    rows = docs.withColumns({hashes["_text"]: F.xxhash64("text"), hashes["_all"]: F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])})
    order = F.struct(hashes["_text"], hashes["_all"])
    first = rows.groupBy("doc_id").agg(F.min(order).alias(hashes["_first"])).join(kept, "doc_id", "left_semi")
    first = first.select("doc_id", f"{hashes['_first']}.*")
    known = rows.join(first, ["doc_id", hashes["_text"], hashes["_all"]], "left_semi").dropDuplicates(["doc_id"])  # equal rows
    return known.unionByName(rows.filter(F.col("doc_id").isNull())).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the kept documents' ids in sequences of 1024 tokens.

    Null and empty texts have the end id alone; repeated rows are packed each for itself; only id
    and text are read.
    """
    return packing.pack(docs.select("doc_id", "text"), public_path("byte_bpe_50k.json"), keep_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("near-duplicates", drop_near_duplicates),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # a trained classifier and packing cannot be stated in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs
