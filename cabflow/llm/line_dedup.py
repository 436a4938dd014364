"""Line dedup across documents, with DataFrame functions only.

Every long enough line becomes a 128-bit hash of its key. The hashes are range
partitioned by line and document, so that a line found in a third of all documents
fills many partitions, and sorted there by line, document (the largest first) and
position. A window streams over these sorted runs and keeps the first occurrence of
each line in each document; it needs the order, so the sort is part of the plan. The
input partition that a row came from is the last range key: rows that share an id,
of which there may be any number, are spread too, and their first occurrences meet
as one document afterwards. The runs of a line in several partitions are counted
there and joined by a sum: how many documents it has, and the first of them, which
keeps it. Lines of enough documents are joined back to the hashes. What comes out is
not text but one sparse bitmap for each document that loses lines: (word, bits)
pairs, 64 lines a word, words without a dropped line left out. ``apply_bitmaps``
joins them to the documents.

Defined results: null or empty text is one empty line; texts of any length are split whole; a null document id is one
document, before all others; rows that share an id are one document whose rows
keep their own lines; repeated rows get the same bitmap; an empty table gives an
empty table; other columns pass through, and a new column whose name is taken
gets an underscore more.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabflow.llm.common import fresh_name, shuffle_partitions, stored, unstore

# The white space stripped from a key, [\x20\x09-\x0D].
STRIPPED = " \t\n\x0b\x0c\r"
WORD_BITS = 64


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(STRIPPED)), string.ascii_uppercase, string.ascii_lowercase)


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def keep_bitmaps(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """(doc, row, n_dropped, dropped) for each row of ``docs`` that loses lines.

    A line whose key has at least ``min_chars`` code points and is found in at least
    ``min_docs`` documents is dropped from all but the one with the largest id.
    ``row`` is the text's hash; ``dropped`` is the sparse bitmap of dropped lines.
    """
    lines = docs.select(
        F.col(f"`{key}`").alias("doc"),
        F.xxhash64(F.col(f"`{text}`")).alias("row"),
        F.posexplode(split_lines(F.col(f"`{text}`"))).alias("pos", "line"),
    ).filter(F.char_length("line") >= min_chars)
    keyed = lines.withColumn("line", line_key(F.col("line"))).filter(F.char_length("line") >= min_chars)
    hashes = [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")]
    hashed = stored(keyed.select("doc", "row", "pos", *hashes, F.spark_partition_id().alias("part")), "line-hashes")
    often = stored(_frequent(first_occurrences(hashed), min_docs), "frequent-lines")  # two stored sides: a skewed join is split
    dropped = hashed.join(often, ["h1", "h2"]).filter(F.col("doc").isNull() | (F.col("doc") < F.col("holder")))
    words = dropped.groupBy("doc", "row", F.shiftright("pos", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, pos & 63)")).alias("bits")
    )
    bitmaps = words.groupBy("doc", "row").agg(
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("dropped"),
    )
    maps = stored(bitmaps, "line-bitmaps")
    unstore(hashed, often)
    return maps


def first_occurrences(hashed: DataFrame) -> DataFrame:
    """The first row of each line in each document of (h1, h2, doc, part, pos), streamed from sorted runs.

    Documents whose rows came from several input partitions have one for each of these.
    """
    runs = hashed.repartitionByRange(shuffle_partitions(hashed.sparkSession), "h1", "h2", F.col("doc").desc(), "part")
    run = Window.partitionBy("h1", "h2", F.col("doc"), "part").orderBy("pos")
    return runs.withColumn("_nth", F.row_number().over(run)).filter(F.col("_nth") == 1).drop("_nth")


def _frequent(first: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2, holder) of the lines that enough documents have."""
    once = first.groupBy("h1", "h2", "doc").agg(F.min("part").alias("part"))
    lines = once.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("holder"))
    return lines.filter(F.col("docs") >= min_docs).select("h1", "h2", "holder")


def _dense(sparse: str) -> Column:
    """The bitmap's words from 0 to its last, gaps filled with 0."""

    def filled(entry: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(F.col(sparse)[i - 1]["word"])
        return F.concat(F.array_repeat(F.lit(0).cast("long"), entry["word"] - before - 1), F.array(entry["bits"]))

    return F.flatten(F.transform(F.col(sparse), filled))


def apply_bitmaps(
    docs: DataFrame, bitmaps: DataFrame, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the text that stays, ``n_lines`` and ``n_dropped``; and the names these columns got."""
    names = {n: fresh_name(docs.columns, n) for n in ("n_lines", "n_dropped", "kept")}
    own = {n: fresh_name(docs.columns, n) for n in ("_doc", "_row", "_n", "_words")}
    # The words are laid out before the join: inside a lambda they would be laid out for every line.
    side = bitmaps.select(
        F.col("doc").alias(own["_doc"]),
        F.col("row").alias(own["_row"]),
        F.col("n_dropped").alias(own["_n"]),
        _dense("dropped").alias(own["_words"]),
    )
    same = F.col(f"`{key}`").eqNullSafe(F.col(own["_doc"])) & (F.xxhash64(F.col(f"`{text}`")) == F.col(own["_row"]))
    joined = docs.join(side.hint("shuffle_hash"), same, "left")
    lines = split_lines(F.col(f"`{text}`"))
    word = lambda i: F.coalesce(F.get(F.col(own["_words"]), F.shiftright(i, 6)), F.lit(0).cast("long"))
    stays = F.filter(lines, lambda _, i: F.getbit(word(i), i.bitwiseAND(WORD_BITS - 1)) == 0)
    kept = F.when(F.col(own["_n"]).isNull(), F.coalesce(F.col(f"`{text}`"), F.lit(""))).otherwise(
        F.array_join(stays, "\n")
    )
    out = joined.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.size(lines).cast("long").alias(names["n_lines"]),
        F.coalesce(own["_n"], F.lit(0).cast("long")).alias(names["n_dropped"]),
        kept.alias(names["kept"]),
    )
    return out, names


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = 40, min_docs: int = 5
) -> tuple[DataFrame, dict[str, str]]:
    """Bitmaps of all lines, applied to the same documents."""
    return apply_bitmaps(docs, keep_bitmaps(docs, key, text, min_chars, min_docs), key, text)
