"""The pipeline's stages against brute force."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from cabflow.llm import line_dedup
from cabflow.llm.queries import QUERIES
from test_llm_lines import brute as brute_lines
from test_llm_minhash import brute as brute_links
from test_llm_packing import held

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def docs_of(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_every_stage_keeps_what_it_should(spark):
    docs = docs_of(spark)
    columns = docs.columns
    first = STAGES["quality classifier"](spark, docs, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    ids = {r.doc_id for r in first}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in ids for i in good) >= 0.97 * len(good) and not any(i in ids for i, q in labels.items() if q == 0)

    repeated = spark.createDataFrame(first, docs.schema)
    second = STAGES["line dedup"](spark, repeated, SF)
    assert second.columns == columns
    want = {d: t for d, _, _, t in brute_lines([(r.doc_id, r.text) for r in first])}
    rows = second.collect()
    assert {r.doc_id: r.text for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)

    third = STAGES["near-duplicates"](spark, second, SF)
    assert third.columns == columns
    links = brute_links([(r.doc_id, r.text) for r in rows], 80)
    kept = third.collect()
    assert sorted(r.doc_id for r in kept) == sorted(i for i, (_, _, k) in links.items() if k)
    assert {r.doc_id: r.text for r in kept}.items() <= want.items()

    last = STAGES["packing"](spark, third, SF).collect()
    held([(r.doc_id, r.text, 0) for r in kept], last, 1024, 256, 1024)


def test_run_is_its_stages_and_is_registered(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "near-duplicates", "packing"]
    assert entry.queries()["pipeline"] is corpus_pipeline.run and set(QUERIES) < set(entry.queries())
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_stages_take_odd_documents(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, None, None, None, None), (3, "same words in both rows here", "en", "s", 28), (3, "same words in both rows here", "en", "s", 28),
            (4, "same words in both rows here", "en", "s", 28)]
    docs = spark.createDataFrame(rows, docs_of(spark).schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert stage(spark, docs.limit(0), SF).isEmpty(), name
        if name == "near-duplicates":
            assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "2", "3", "None"]
        else:
            assert out.count() >= 0


def test_of_rows_that_share_an_id_the_stated_one_stays(spark):
    """The same row whatever the order of the table, although texts differ."""
    texts = {i: f"text number {i} with words of its own {'abcdefgh'[i % 8] * 9} and {i * 7919}" for i in range(40)}
    lone = "one more text, with other words in it than all of those have"
    rows = [(i % 4, texts[i], "en", "s", i) for i in range(40)] + [(9, lone, "en", "s", 0), (9, lone, "en", "s", 0), (9, lone, "de", "s", 0)]
    stage, schema = dict(corpus_pipeline.STAGES)["near-duplicates"], docs_of(spark).schema
    names = [f.name for f in schema.fields]
    order = [names.index(c) for c in ("doc_id", "text", "lang", "source", "n_chars")]
    place = lambda r: tuple(r[order.index(i)] for i in range(5))
    found = set()
    for part in (rows, rows[::-1], rows[20:] + rows[:20]):
        df = spark.createDataFrame([place(r) for r in part], schema).repartition(3).withColumn("_text", F.lit(1))
        got = stage(spark, df, SF)
        assert got.columns == df.columns
        found.add(tuple(sorted(map(repr, got.collect()))))
    assert len(found) == 1 and len(next(iter(found))) == len({r[0] for r in rows})


def test_line_stage_uses_bitmaps_only(spark):
    assert line_dedup.keep_bitmaps(docs_of(spark)).columns == ["doc", "row", "n_dropped", "dropped"]


def test_names():
    assert {k.split("_")[0] for k in QUERIES} == {f"op{i}" for i in range(1, 14)}
