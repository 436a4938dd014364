"""Midstates against hashlib, and manifests against a tree built in plain Python."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from cabflow.llm import merkle, sha


def test_states_are_those_of_the_standard():
    rng = np.random.default_rng(1)
    for blocks in range(9):
        parts = rng.integers(0, 256, (blocks, 50, 32), dtype=np.uint8)
        state = sha.start(50)
        for p in parts:
            state = sha.states(sha.digests(sha.absorb(state, sha.hex_block(p))))  # stored and read back
        got = sha.finished(state, np.full(50, blocks))
        for i in range(50):
            assert got[i].tobytes() == hashlib.sha256(b"".join(p[i].tobytes().hex().encode() for p in parts)).digest()


def H(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def climb(nodes):
    """Levels of a tree, its root last."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        first = i // 8 * 8
        out.append((level[first:i], level[i + 1 : first + 8]))
        i //= 8
    return out


def brute(rows, tampered=lambda i: False):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda i, lang, text: H(field(i) + field(lang) + field(text))
    groups = {}
    for i, lang, text in rows:
        claim = text.upper() if tampered(i) and text is not None else text
        groups.setdefault((lang is not None, (lang or "").encode()), []).append((i is not None, i or 0, leaf(i, lang, text), i, leaf(i, lang, claim)))
    order = sorted(groups)
    trees = {g: climb([m[2] for m in sorted(groups[g])]) for g in order}
    forest = climb([trees[g][-1][0] for g in order])
    out = []
    for at, g in enumerate(order):
        for pos, (_, _, own, i, claim) in enumerate(sorted(groups[g])):
            steps = path(trees[g], pos) + path(forest, at)
            proof = H("".join("".join(a + b) for a, b in steps))
            for a, b in steps:
                claim = H("".join([*a, claim, *b]))
            out.append((i, own, trees[g][-1][0], forest[-1][0], proof, claim, claim == forest[-1][0]))
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    df = df.withColumns({"tree": F.lit(1), "key": F.lit(2), "digest": F.lit(3)})  # other columns, with names used inside
    return sorted(map(tuple, merkle.manifest(df, ["doc_id", "lang", "text"], **kw).prove().collect()), key=repr)


def some(n, langs, seed=1):
    rng = random.Random(seed)
    return [(i * 3, rng.choice(langs), rng.choice(["", None, "-", "Text ä", "x" * 200, f"t{i}"])) for i in range(n)]


def test_trees_of_every_shape(spark):
    for n in (1, 2, 7, 8, 9, 64, 65, 72, 73):
        rows = some(n, ["en"])
        assert run(spark, rows) == brute(rows)


def test_many_groups_nulls_and_repeated_rows(spark):
    rows = some(300, [None, "", "-", "=", "en", "é", "z", *[f"l{i}" for i in range(10)]])
    rows += [(None, "en", "no id"), (None, None, None), (9, "en", "tie"), (9, "en", "other"), *[(9, "en", "tie")] * 3]
    assert run(spark, rows) == brute(rows)


def test_several_rounds_and_changed_texts(spark):
    rows = some(5000, ["hot"]) + some(700, ["en", None], 2) + some(3, ["rare"], 3)
    changed = dict(claims={"text": F.upper("text")}, claimed=F.col("doc_id") % 2 == 0)
    got = run(spark, rows, **changed)
    assert got == brute(rows, lambda i: i % 2 == 0)
    assert {r[-1] for r in got} == {True, False}
    assert {r[-1] for r in run(spark, rows, claims={"text": F.col("text")})} == {True}


def test_more_subroots_than_a_block(spark):
    rows = [(i, f"lang {i:04}", "t") for i in range(1100)]
    assert run(spark, rows) == brute(rows)


def test_text_keys_and_empty_table(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), (None, "x")], "leaf string, lang string")
    assert merkle.manifest(df.limit(0), ["leaf"], key="leaf").prove().isEmpty()
    assert merkle.manifest(df, ["leaf"], key="leaf").prove().count() == 3


def test_a_group_in_many_partitions_is_numbered_without_gaps(spark):
    df = spark.range(2000).select(F.lit("one").alias("tree"), (F.col("id") % 3).alias("k"), F.col("id").alias("row"))
    placed = merkle.in_order(df, "tree", ["k", "row"])
    rows = sorted((r["pos"], r["k"], r["row"], r["size"]) for r in placed.collect())
    assert [r[0] for r in rows] == list(range(2000)) and {r[3] for r in rows} == {2000}
    assert [r[1:3] for r in rows] == sorted(r[1:3] for r in rows)
