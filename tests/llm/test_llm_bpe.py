"""BPE: whole texts against the tokenizers library, with and without tree concatenation."""

import random

import pytest

from cabflow.llm import bpe
from cabflow.llm.tokens import decoder, public_path, text_encoder, tokenizer

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
TEXTS = [
    "", "a", " lead", "trail ", "two  spaces\t\ttabs\r\nlines\n\n\nend ", "x<|endoftext|>y <|startoftext|>z<|endo", "don't I'LL we'Re 's!!'s",
    "Ünï 漢字カナ 😀👩‍👩‍👧 ﬁ İ ΑΣ é́ ½ ² ª µ", "a b c　d\x01\x02\x1f", "no-space-" * 400, "漢字" * 700, "é́" * 300, "12 345 6789", "\n\n", "word " * 3000,
]


def library(path, texts):
    return [tokenizer(path).encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("name", FILES)
def test_columns_of_texts_equal_the_library(name):
    import numpy as np
    import pyarrow as pa

    path = public_path(name)
    ids, at = text_encoder(path).encode(pa.array(TEXTS))
    want = library(path, TEXTS)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want
    assert text_encoder(path).encode(pa.array([], pa.string()))[1].tolist() == [0]
    got = decoder(path).decode(ids.astype(np.int64), at)
    assert got == [tokenizer(path).decode(x, skip_special_tokens=False) for x in want]


@pytest.mark.parametrize("name", FILES)
def test_joined_halves_equal_the_whole(name):
    path, rng = public_path(name), random.Random(3)
    parts = ["the", "'s", "<|endoftext|>", "ab", "!!", " ", "́", "ing", "12", "é", "漢", "\n", "  "]
    for k in range(600):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 60)))
        at = bpe.cuts(text, rng.randint(2, 40))
        pieces = [(text[a:b], *bpe.encode_with_places(path, text[a:b])) for a, b in zip(at[:-1], at[1:])]
        assert bpe.join_tree(path, pieces)[1].tolist() == library(path, [text])[0], (text, at)


@pytest.mark.parametrize("name", FILES)
def test_frames_with_nulls_repeats_and_clashing_columns(spark, name):
    path = public_path(name)
    rows = [(i, t, "x", i) for i, t in enumerate([*TEXTS, None, TEXTS[9], TEXTS[9]])] + [(None, "no id", None, None), (9, TEXTS[9], "x", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, _row int")
    for leaf in (300, 10**6):
        got = bpe.encode(df, path, leaf_chars=leaf).collect()
        assert sorted(((r.doc_id, r.text, r["ids"], tuple(r["ids_"])) for r in got), key=str) == sorted(
            ((r[0], r[1], r[2], tuple(x)) for r, x in zip(rows, library(path, [r[1] for r in rows]))), key=str
        )
        both = bpe.encode(df, path, leaf_chars=leaf, decoded="text").collect()
        assert all(r["text_"] == tokenizer(path).decode(r["ids_"], skip_special_tokens=False) for r in both) and len(both) == len(rows)
    assert bpe.encode(df.limit(0), path).columns == ["doc_id", "text", "ids", "_row", "ids_"]
    assert bpe.encode(df.limit(0), path).isEmpty()
    none = spark.createDataFrame([(1, None)], "k int, ids array<int>")
    assert bpe.decode(none, path).first().decoded == ""
    assert bpe.decode(none.limit(0), path).isEmpty()


def test_query_equals_the_library(spark):
    import hashlib

    from cabflow.llm.queries import op1_bpe

    sf, path = "/root/testdata/sf0.001", public_path(FILES[0])
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op1_bpe(spark, sf).collect()
    assert len(got) == len(docs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in got:
        ids = library(path, [docs[r.doc_id]])[0]
        text = tokenizer(path).decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(text))
