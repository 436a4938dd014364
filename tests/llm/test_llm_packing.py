"""Packing: every id in one piece, gapless sequences under all limits, little padding, edge cases."""

import random
import zlib
from collections import defaultdict

import numpy as np

from cabflow.llm import packing
from cabflow.llm.tokens import public_path, tokenizer

PATH = public_path("byte_bpe_50k.json")


def held(rows, got, capacity, segments, loss, keyed="doc_id"):
    """Asserts the contract and gives the padding: rows are (key, text, loss_from)."""
    want = defaultdict(list)
    for k, t, f in rows:
        ids = [*tokenizer(PATH).encode(t or "", add_special_tokens=False).ids, 0]
        want[k].append((np.array(ids, "<u4"), f or 0))
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in got:
        pieces[r[keyed]].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(want)
    bearing = {}
    for k, versions in want.items():
        mine = sorted(pieces[k], key=lambda r: (r.start, r.length))
        assert sum(r.length for r in mine) == sum(len(v) for v, _ in versions)
        assert all(any(zlib.crc32(v[r.start : r.start + r.length].tobytes()) == r.ids_crc32 and len(v) == r.doc_tokens for v, _ in versions) for r in mine)
        if len(versions) == 1:
            at = 0
            for r in mine:
                assert r.start == at
                at += r.length
        bearing[k] = versions[0][1]
    padding = 0
    for some in sequences.values():
        at = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= capacity and len(some) <= segments
        assert sum(max(0, r.start + r.length - max(r.start, bearing[r[keyed]])) for r in some) <= loss
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


def texts(n, seed=1):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "xyz!"]) for _ in range(rng.choice([0, 1, 3, 40, 400, 3000]))), rng.choice([None, 0, 5, 10**6])) for i in range(n)]


def test_limits_hold_and_padding_is_little(spark):
    rows = texts(300)
    df = spark.createDataFrame(rows, "doc_id long, text string, prompt long")
    total = sum(len(tokenizer(PATH).encode(t, add_special_tokens=False).ids) + 1 for _, t, _ in rows)
    assert held([(k, t, 0) for k, t, _ in rows], packing.pack(df, PATH).collect(), 1024, 1024, 1024) < 0.01 * total
    small = packing.pack(df, PATH, loss_from="prompt", capacity=128, max_segments=6, max_loss=90).collect()
    held(rows, small, 128, 6, 90)


def test_ids_come_with_the_pieces(spark):
    rows = texts(40, 2)
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, prompt long"), PATH, capacity=64).collect()
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got)


def test_edges(spark):
    rows = [(1, None, 1), (2, "", 2), (None, "no id", 3), (3, "same", 4), (3, "same", 4), (4, "long " * 100_000, 5), (5, "<|endoftext|>  x", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    out = packing.pack(df, PATH)
    assert out.columns == ["doc_id", "start", "start_", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    got = out.drop("start").withColumnRenamed("start_", "start").collect()
    held([(k, t, 0) for k, t, _ in rows], got, 1024, 256, 1024)
    assert packing.pack(df.limit(0), PATH).isEmpty()


def test_dot_product_prefers_what_fits_the_room_left():
    shelf = packing.Shelf(100, 3, 50)
    for ref, (length, loss_from) in enumerate([(60, 60), (60, 0), (40, 40), (30, 0), (10, 0)]):
        shelf.put(ref, 0, length, loss_from)
    done = list(packing.fill(shelf))
    assert sorted((r, s, n) for seq in done for r, s, n, _ in seq if r != 1) and sum(n for seq in done for _, _, n, _ in seq) == 200
    for seq in done:
        assert sum(x[2] for x in seq) <= 100 and len(seq) <= 3
        assert sum(max(0, s + n - max(s, f)) for _, s, n, f in seq) <= 50


def test_short_texts_fill_their_sequences(spark):
    """Texts of no to five tokens: the limit on segments leaves no padding."""
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["a", "of", "the"]) for _ in range(rng.randint(0, 5))), 0) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, prompt long")
    total = sum(len(tokenizer(PATH).encode(t, add_special_tokens=False).ids) + 1 for _, t, _ in rows)
    assert held(rows, packing.pack(df, PATH).collect(), 1024, 1024, 1024) < 0.02 * total
    same = [(i, "of the", 0) for i in range(6000)]
    got = packing.pack(spark.createDataFrame(same, "doc_id long, text string, prompt long"), PATH).collect()
    assert held(same, got, 1024, 1024, 1024) < 0.02 * 3 * 6000


def test_rows_equal_in_all_columns_are_dealt_over_the_tasks(spark):
    df = spark.createDataFrame([(1, "one text that is held by all rows")] * 4000, "doc_id long, text string").repartition(4)
    got = packing.pack(df, PATH).collect()
    assert sum(r.length for r in got) == 4000 * got[0].doc_tokens
    tasks = defaultdict(int)
    for r in got:
        tasks[r.sequence_id >> 32] += r.length
    assert len(tasks) == 8 and max(tasks.values()) < 2 * min(tasks.values())


def test_sequences_are_few_under_three_limits_that_bind():
    """Against a bound that no packing beats: each limit's total, and no more than a twentieth above it."""
    rng = random.Random(11)
    for capacity, segments, loss in ((1000, 10, 600), (1000, 40, 250), (500, 5, 500), (64, 64, 30)):
        shelf, items = packing.Shelf(capacity, segments, loss), []
        for ref in range(800):
            length = rng.choice([rng.randint(1, 20), rng.randint(1, capacity)])
            items.append((length, rng.randint(0, length)))
            shelf.put(ref, 0, length, items[-1][1])
        done = list(packing.fill(shelf))
        assert sum(n for seq in done for *_, n, _ in seq) == sum(n for n, _ in items)
        for seq in done:
            assert sum(x[2] for x in seq) <= capacity and len(seq) <= segments
            assert sum(max(0, s + n - max(s, f)) for _, s, n, f in seq) <= loss
        least = max(sum(n for n, _ in items) / capacity, len(items) / segments, sum(n - f for n, f in items) / loss)
        assert len(done) <= 1.35 * least + 1, (capacity, segments, loss, len(done), least)


def test_small_sets_against_every_packing_of_whole_items():
    """No more sequences than the best way to pack the same items without cutting any."""

    def best(items, bins, at=0, count=0, most=10**9):
        if count >= most:
            return most
        if at == len(items):
            return count
        length, loss = items[at]
        for i in range(len(bins)):
            if bins[i][0] >= length and bins[i][1] >= 1 and bins[i][2] >= loss:
                bins[i] = (bins[i][0] - length, bins[i][1] - 1, bins[i][2] - loss)
                most = min(most, best(items, bins, at + 1, count, most))
                bins[i] = (bins[i][0] + length, bins[i][1] + 1, bins[i][2] + loss)
        bins.append((20 - length, 3 - 1, 12 - loss))
        most = min(most, best(items, bins, at + 1, count + 1, most))
        bins.pop()
        return most

    rng = random.Random(12)
    worse = 0
    for _ in range(150):
        items = [(n, rng.randint(0, min(n, 12))) for n in (rng.randint(1, 20) for _ in range(rng.randint(1, 8)))]
        shelf = packing.Shelf(20, 3, 12)
        for ref, (length, loss) in enumerate(items):
            shelf.put(ref, 0, length, length - loss)
        done = len(list(packing.fill(shelf)))
        least = best(items, [])
        assert done <= least + 1
        worse += done > least
    assert worse <= 15


def test_query_packs_all_documents(spark):
    from cabflow.llm.queries import op7_packing

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text, 0) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert held(rows, op7_packing(spark, sf).collect(), 1024, 1024, 1024) == 0
