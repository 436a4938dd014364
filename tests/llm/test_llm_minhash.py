"""MinHash near-dedup against all pairs of exact sets, components, skew, and edge cases."""

import random
import re

import pytest

from cabflow.llm import components, minhash


def sets_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute(rows, percent):
    """{id: (set size, component, kept)} from all pairs."""
    sets = {i: sets_of(t) for i, t in rows}
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def run(spark, rows, percent=85, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df, percent=percent, **more).collect()}


def family(rng, words, n, edits):
    """Copies of one text, each with some words of its own: many pairs near the threshold."""
    base = [rng.choice(words) for _ in range(120)]
    out = []
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(len(text))] = rng.choice(words)
        out.append(" ".join(text))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 80))) for _ in range(120)]
    for edits in (1, 2, 3, 4, 5):
        texts += family(rng, words, 25, edits)
    texts += [rng.choice(texts).upper() for _ in range(60)] + [texts[0]] * 60
    # a chain: each text is linked with the next only
    chain = [rng.choice(words) for _ in range(400)]
    texts += [" ".join(chain[i * 8 : i * 8 + 200]) for i in range(20)]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_equals_all_pairs(spark):
    rows = corpus(1)
    assert run(spark, rows) == brute(rows, 85)


def test_crowded_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 700)
    rng = random.Random(3)
    rows = list(enumerate(family(rng, [f"w{i}" for i in range(500)], 70, 6)))
    assert run(spark, rows, 80) == brute(rows, 80)


def test_edges(spark):
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one two"), (4, "ONE  two"), (5, "one two three"), (6, "long " * 100_000), (7, "long " * 50_000), (8, "Ä b"), (9, "ä b")]
    assert run(spark, rows) == brute(rows, 85)
    df = spark.createDataFrame([(1, "a b c d e f", 1), (1, "a b c d e f", 1), (None, "a b c d e f", 2), (None, None, 3), (2, "a b c d e F", 4)], "doc_id long, text string, kept int")
    got = sorted(map(str, minhash.near_duplicates(df).collect()))
    assert len(got) == 5 and sum("component_id=1, kept=True" in g for g in got) == 2 and sum("component_id=1, kept=False" in g for g in got) == 1
    assert sum("doc_id=None" in g and "kept=True" in g for g in got) == 2
    assert minhash.near_duplicates(df.limit(0)).isEmpty()
    with pytest.raises(ValueError):
        minhash.near_duplicates(df, percent=50)


def test_components_of_random_graphs(spark):
    rng = random.Random(7)
    for n, m in ((60, 40), (200, 150), (50, 300)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(1000 + i, 1001 + i) for i in range(40)]
        parent = {}

        def root(i):
            parent.setdefault(i, i)
            while parent[i] != i:
                i = parent[i]
            return i

        for a, b in edges:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
        want = {i: root(i) for i in parent}
        got = components.connected_components(spark.createDataFrame(edges, "a long, b long"))
        found = {r.node: r.component for r in got.collect()}
        assert len(found) == got.count()
        lonely = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
        assert found == {i: c for i, c in want.items() if i not in lonely}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).isEmpty()
