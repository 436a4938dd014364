"""Line dedup against a brute-force version, its plan, and edge cases."""

import random
from collections import defaultdict

from cabflow.llm import line_dedup

WHITE = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=40, min_docs=5):
    """(doc, lines, dropped, kept text) for each row."""
    low = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)
    key = lambda s: low(s.strip(WHITE))
    docs = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            docs[key(line)].add(d)
    rank = lambda d: (d is not None, d or 0)
    often = {k: max(ds, key=rank) for k, ds in docs.items() if len(k) >= min_chars and len(ds) >= min_docs}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in often or often[key(x)] == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def run(spark, rows, **limits):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out, n = line_dedup.dedup_lines(df, **limits)
    return sorted(((r.doc_id, r[n["n_lines"]], r[n["n_dropped"]], r[n["kept"]]) for r in out.collect()), key=str)


def test_random_documents(spark):
    rng = random.Random(4)
    common = [f"Line number {i} with more than forty characters in it, Ä " for i in range(30)] + ["short", "", "x" * 39, "y" * 40]
    rows = []
    for d in range(300):
        lines = [rng.choice(common) for _ in range(rng.randint(0, 150 if d % 50 == 0 else 6))]
        lines = [(rng.choice(WHITE.replace("\n", "")) + x.upper() if rng.random() < 0.3 else x + " \t") for x in lines]
        rows.append((d, "\n".join(lines)))
    rows += [(d, "The hot line is in every one of these documents, again.\nthe hot line is in every one of these documents, again.") for d in range(300, 500)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, min_chars=5, min_docs=2) == brute(rows, 5, 2)


def test_edges(spark):
    line = "a line that is long enough to be counted among the repeated"
    rows = [(i, line) for i in range(5)] + [(None, line), (None, f"other\n{line}"), (7, None), (8, ""), (9, "\n"), (4, f"{line}\nsame id, other text"), (3, line)]
    rows += [(20 + i, "\n".join([line] * 200 + [f"own {i}"])) for i in range(2)]
    assert run(spark, rows) == brute(rows)
    df = spark.createDataFrame([(1, "x", 5, 6)], "doc_id long, text string, n_lines int, kept int")
    out, n = line_dedup.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "n_lines", "kept", "n_lines_", "n_dropped", "kept_"] and out.first().n_lines == 5
    assert line_dedup.dedup_lines(df.limit(0))[0].isEmpty()


def test_bitmaps_are_sparse_and_native(spark):
    line = "a line that is long enough to be counted among the repeated"
    rows = [(i, "\n".join(["own %d" % i] * 1000 + [line])) for i in range(6)]
    maps = line_dedup.keep_bitmaps(spark.createDataFrame(rows, "doc_id long, text string"))
    got = maps.collect()
    assert sorted(r.doc for r in got) == [0, 1, 2, 3, 4]
    assert all([(w.word, w.bits) for w in r.dropped] == [(1000 // 64, 1 << (1000 % 64))] and r.n_dropped == 1 for r in got)
    out, _ = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_first_occurrences_are_streamed_from_sorted_runs(spark):
    """The plan keeps the sort that the window over the range partitions needs, without another exchange between."""
    from pyspark.sql import functions as F

    rows = [(i % 7, 1, d, 0, p) for i in range(50) for d in (None, 1, 2) for p in (3, 1)]
    hashed = spark.createDataFrame(rows, "h1 long, h2 long, doc long, part int, pos int")
    first = line_dedup.first_occurrences(hashed)
    assert sorted(map(str, first.select("h1", "doc", "pos").collect())) == sorted(
        map(str, spark.createDataFrame([(h, d, 1) for h in range(7) for d in (None, 1, 2)], "h1 long, doc long, pos int").collect())
    )
    plan = first._jdf.queryExecution().executedPlan().toString().splitlines()
    steps = [next(w for w in ("Window", "Sort", "Exchange") if w in ln) for ln in plan if any(w in ln for w in ("Window", "Sort ", "Exchange"))]
    final = steps[: steps.index("Exchange") + 1]
    assert "Sort" in final and final[0] == "Window" and final[-1] == "Exchange", plan
    assert any("rangepartitioning(h1" in ln for ln in plan)
    assert line_dedup.first_occurrences(hashed.withColumn("part", F.lit(1)).limit(0)).isEmpty()


def test_rows_that_share_an_id_in_many_partitions_are_one_document(spark):
    line = "a line that is long enough to be counted among the repeated"
    rows = [(7, line)] * 300 + [(7, f"{line}\nother {i}") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert line_dedup.keep_bitmaps(df).isEmpty()  # one document has it
    more = df.union(spark.createDataFrame([(i, line) for i in range(3, 7)], "doc_id long, text string"))
    assert sorted(r.doc for r in line_dedup.keep_bitmaps(more).collect()) == [3, 4, 5, 6]


def test_any_column_name_passes_through(spark):
    df = spark.createDataFrame([(1, "x", 2, 3, 4)], "doc_id long, text string, _doc int, _row int, _words int")
    out, _ = line_dedup.dedup_lines(df)
    assert out.first()["_words"] == 4 and out.columns[:5] == df.columns
