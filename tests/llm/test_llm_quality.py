"""Quality classifier: held-out accuracy, the risk it minimises, the prior, and edge cases."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from cabflow.llm import quality
from cabflow.llm.queries import op2_quality

SF = "/root/testdata/sf0.01"


def test_held_out_labels_are_predicted(spark):
    got = {r.doc_id: r for r in op2_quality(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [(got[x.doc_id], x.quality) for x in labels if zlib.crc32(str(x.doc_id).encode()) % 5 == 0]
    assert all(r.held_out for r, _ in held) and all(0 <= r.score <= 1 for r in got.values())
    assert np.mean([r.predicted == q for r, q in held]) > 0.93
    assert all(r.predicted == (r.score >= 0.3) for r in got.values())


def test_both_labels_are_recalled_on_held_out_rows(spark):
    """A classifier that keeps all documents, or drops all, is right on one label only."""
    sf = "/root/testdata/sf0.1"
    predicted = {r.doc_id: r.predicted for r in op2_quality(spark, sf).select("doc_id", "predicted").collect()}
    held = [x for x in spark.read.parquet(f"{sf}/labels.parquet").collect() if zlib.crc32(str(x.doc_id).encode()) % 5 == 0]
    for label in (0, 1):
        own = [predicted[x.doc_id] == label for x in held if x.quality == label]
        assert len(own) > 50 and np.mean(own) >= 0.95, label


def test_labels_and_ids_are_no_inputs(spark):
    docs = spark.createDataFrame([(1, "same text\n"), (2, "same text\n"), (2, "same text\n")], "doc_id long, text string")
    model = quality.Model(np.zeros(quality.N_FEATURES), np.ones(quality.N_FEATURES), np.ones(quality.N_FEATURES), -3.0, 0.5)
    assert len({r.score for r in quality.score(docs, model).collect()}) == 1


def test_features_by_hand():
    x = quality.features(pa.array(["", "ab AB\n!", None if False else "é"]))
    assert not x[0].any()
    k = quality.K
    assert np.isclose(x[1][k * k] ** 2, 2 / 7) and np.isclose(x[1][k * k + 1] ** 2, 2 / 7)  # lower, upper
    assert np.isclose((x[1][: k * k] ** 2).sum(), 1.0)
    many = pa.array([t for t in ["one two", "THREE!!", "", "a|b"] * 50])
    assert np.array_equal(quality.features(many)[:4], quality.features(many.slice(4, 4)))


def test_nonnegative_risk_separates_and_prior_is_found():
    rng = np.random.default_rng(5)
    good, bad = rng.normal(1.5, 1, (3000, 4)), rng.normal(-1.5, 1, (3000, 4))
    unlabelled = np.vstack([good[:1400], bad[:600]])
    first = quality.fit_nnpu(good[1400:], unlabelled, 0.5)
    bins = lambda x: np.histogram(first.score(x), quality.BINS, (0, 1))[0]
    prior = quality.best_bin_prior(bins(good[1400:]), bins(unlabelled))
    assert abs(prior - 0.7) < 0.06
    model = quality.fit_nnpu(good[1400:], unlabelled, prior)
    assert (model.score(bad[600:]) < 0.3).mean() > 0.95 and (model.score(good[:1400]) >= 0.3).mean() > 0.95
    assert quality.best_bin_prior(np.zeros(5), np.zeros(5)) == 0.5


def test_edges(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["good", "words", "here"]) for _ in range(30)) if i % 3 else "BAD!! WORDS!! " * 9, 7.0) for i in range(300)]
    rows += [(None, "text", None), (300, None, None), (301, "", 1.0), (302, "long " * 50_000, 1.0), (302, "long " * 50_000, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    trusted = docs.filter("doc_id % 3 != 0 and doc_id < 200").select("doc_id")
    model = quality.train(docs, trusted)
    out = quality.score(docs, model)
    assert out.columns == ["doc_id", "text", "score", "score_"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r["score_"] <= 1 for r in got)
    assert len({r["score_"] for r in got if not r.text}) == 1
    assert all(r["score_"] < 0.3 for r in got if (r.text or "").startswith("BAD"))
    assert all(r["score_"] > 0.3 for r in got if r.doc_id is not None and r.doc_id % 3 and r.doc_id < 300)
    assert quality.train(docs, trusted.limit(0)) is None and quality.train(docs.limit(0), trusted) is None
    assert {r["score_"] for r in quality.score(docs, None).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).isEmpty()


def test_samples_of_very_large_tables_are_not_empty(spark):
    """A share below a millionth, as of more than 8.2e9 texts, still chooses its part."""
    from cabflow.llm.common import sampled

    ids = spark.range(4_000_000)
    for share in (5e-6, 9e-7):
        assert 0 < ids.filter(sampled(17, share, "id")).count() < 20 * 4_000_000 * share
    assert ids.filter(sampled(17, 0.25, "id")).count() == pytest.approx(1_000_000, rel=0.01)
    assert ids.filter(quality._sampled("id", 8192, 4_000_000)).count() == pytest.approx(8192, rel=0.1)


def test_an_empty_sample_is_an_error(spark):
    docs = spark.createDataFrame([(i, f"text {i} of some words") for i in range(50)], "doc_id long, text string")
    good = spark.createDataFrame([(1,), (2,)], "doc_id long")
    for more in ({"max_unlabelled": 0}, {"max_positives": 0}):
        with pytest.raises(ValueError, match="sample"):
            quality.train(docs, good, **more)
    assert quality.train(docs, good.filter("doc_id > 9")) is None
    assert quality.train(docs.limit(0), good) is None
    assert quality.train(docs.filter("doc_id > 9"), good) is None
