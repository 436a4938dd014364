"""Registered queries of this subpackage: thin uses of the operators on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabflow.llm import (
    bpe,
    exact_dedup,
    fingerprints,
    licenses,
    line_dedup,
    merkle,
    minhash,
    packing,
    pages,
    quality,
    topk,
    warc,
    whitening,
)
from cabflow.llm.common import scratch, table
from cabflow.llm.tokens import public_path
from cabflow.session import remove


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_path("word_bpe_49k.json")
    return bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def held_out(key: str = "doc_id"):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model | None:
    """The classifier fitted on the rows that are not held out."""
    trusted = table(spark, sf_dir, "labels").filter((F.col("quality") == 1) & ~held_out()).select("doc_id")
    return quality.train(docs.select("doc_id", "text").filter(~held_out()), trusted)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model(spark, docs, sf_dir)
    return quality.score(docs, model).select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).cast("int").alias("predicted"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, n = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", n["n_lines"], n["n_dropped"], F.sha2(n["kept"], 256).alias("kept_sha256"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_path("byte_bpe_50k.json"), keep_ids=False)


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archives(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    records = warc.read_archives(spark, path)  # a table of its own, without the payloads
    remove(spark, path)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.against_next(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors, components=4)
    rows, new = whitening.whiten(vectors, model)
    explained = F.array(*[F.lit(x) for x in model.explained]).cast("array<double>")
    each = rows.select("vec_id", F.col(new["deviation"]).alias("deviation"), F.posexplode(new["whitened"]).alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, "at").alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, new = exact_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        F.col(new["keep_id"]).alias("keep_id"),
        F.col(new["group_size"]).alias("group_size"),
        F.col(new["kept"]).alias("kept"),
        F.lower(F.hex(new["digest"])).alias("text_sha256"),
    )


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return merkle.manifest(
        docs,
        ["doc_id", "source", "lang", "n_chars", "text"],
        claims={"text": F.translate("text", upper, upper.lower())},
        claimed=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0,
    ).prove()


def merkle_sql(levels: int = 7, forest_levels: int = 3) -> str:
    """SQL of ``op13_merkle`` for groups of at most 8**levels rows and 8**forest_levels groups."""

    def climbed(name: str, n: int) -> str:
        """Level by level: each row's own siblings as text, the node above it, and what its claim folds to."""
        out = ""
        for i in range(n):
            below = f"{name}{i}"
            # the run of a node's level, once for each node, then the rows that stand below it
            out += f""", {below}n AS (
  SELECT tree, node, size, any_value(digest) AS digest FROM {below} GROUP BY tree, node, size
), {below}r AS (
  SELECT tree, node // 8 AS up, size, string_agg(digest, '' ORDER BY node) AS run FROM {below}n GROUP BY tree, node // 8, size
), {name}{i + 1} AS (
  SELECT b.doc_id, b.leaf, b.tree, b.node // 8 AS node, (b.size + 7) // 8 AS size,
         CASE WHEN b.size > 1 THEN sha256(r.run) ELSE b.digest END AS digest,
         CASE WHEN b.size > 1 THEN sha256(left(r.run, 64 * (b.node % 8)) || b.folded || substr(r.run, 64 * (b.node % 8) + 65)) ELSE b.folded END AS folded,
         b.proof || left(r.run, 64 * (b.node % 8)) || substr(r.run, 64 * (b.node % 8) + 65) AS proof{", b.subroot" if name == "f" else ""}
  FROM {below} b JOIN {below}r r ON r.tree = b.tree AND r.up = b.node // 8
)"""
        return out

    def leaf(text: str) -> str:
        fields = [f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)]
        return f"sha256({' || '.join(fields)})"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = """xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
      lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295)"""
    return f"""
WITH hashed AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {leaf("text")} AS leaf,
         CASE WHEN {crc} % 3 = 0 THEN {leaf(lower)} ELSE {leaf("text")} END AS claim
  FROM documents
), l0 AS (
  SELECT doc_id, leaf, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS node,
         count(*) OVER (PARTITION BY tree) AS size, leaf AS digest, claim AS folded, '' AS proof
  FROM hashed
){climbed("l", levels)}, places AS (
  SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS node, count(*) OVER () AS size FROM (SELECT DISTINCT tree FROM l{levels})
), f0 AS (
  SELECT l.doc_id, l.leaf, '' AS tree, p.node, p.size, l.digest, l.folded, l.proof, l.digest AS subroot
  FROM l{levels} l JOIN places p ON p.tree = l.tree
){climbed("f", forest_levels)}
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = digest AS verified
FROM f{forest_levels}
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_quality": op2_quality,
    "op3_line_dedup": op3_line_dedup,
    "op4_topk": op4_topk,
    "op5_licenses": op5_licenses,
    "op6_pages": op6_pages,
    "op7_packing": op7_packing,
    "op8_minhash": op8_minhash,
    "op9_warc": op9_warc,
    "op10_fingerprints": op10_fingerprints,
    "op11_whitening": op11_whitening,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_merkle": op13_merkle,
}

# SQL with equal results, where SQL can state them.
ORACLE_SQL: dict[str, str] = {
    "op3_line_dedup": """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), often AS (
  SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.doc_id, k.pos, k.line, o.holder IS NOT NULL AND k.doc_id < o.holder AS dropped
  FROM keyed k LEFT JOIN often o ON k.key = o.key
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op4_topk": """
WITH parts AS (
  SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
), scaled AS (
  SELECT vec_id, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM parts
  WHERE vec_id NOT IN (SELECT vec_id FROM parts WHERE x IS NULL OR NOT isfinite(x))
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM scaled q JOIN scaled c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY 1, 2
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op9_warc": """
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
), numbered AS (
  SELECT page_id, strlen(body) AS payload_bytes, hex,
         list_transform(range(8), lambda i: CAST('0x' || substr(hex, CAST(1 + 5 * i AS INTEGER), 5) AS BIGINT)) AS parts
  FROM hashed
), coded AS (
  SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
         array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((parts[CAST(i // 4 + 1 AS INTEGER)] >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest
  FROM numbered
), best AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS original FROM coded
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
       CAST(CASE WHEN page_id < original THEN original END AS DOUBLE) AS refers_to
FROM best
""",
    "op12_exact_dedup": """
WITH hashed AS (SELECT doc_id, coalesce(text, '') AS body FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM hashed WINDOW same AS (PARTITION BY body)
""",
    "op13_merkle": merkle_sql(),
}
