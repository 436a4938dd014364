"""License scans: planted notices and near misses, against all windows and templates, and edge cases."""

import random
import re
import textwrap

from cabflow.llm import licenses


def found(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string, license string")
    return sorted(((r.doc_id, r["license_"], r.start, r.end, r.notice) for r in licenses.scan(df, **more).collect()), key=str)


def test_planted_notices_are_found_and_clean_texts_left_alone(spark):
    rng = random.Random(6)
    filler = lambda n: " ".join(rng.choice("of the and license plates right permission is not code warranty".split()) for _ in range(n))
    rows, want = [], []
    for i, (name, wording) in enumerate(sorted(licenses.TEMPLATES.items()) * 3):
        before, after = filler(rng.choice([0, 5, 400])), filler(rng.choice([0, 5, 400]))
        glue = rng.choice(["\n", " "])
        text = before + glue + wording.upper() * (i % 2) + wording * (1 - i % 2) + glue + after
        rows.append((i, text, "x"))
        start = len(before) + 1
        want.append((i, name, wording, text, start))
    rows += [(1000 + i, filler(50), "clean") for i in range(20)]
    got = found(spark, rows)
    spans = {}
    for d, name, start, end, notice in got:
        spans.setdefault(d, []).append((name, start, end))
        assert next(t for i, t, _ in rows if i == d)[start:end] == notice
    for i, name, wording, text, start in want:
        assert any(n == name and s <= start + 2 and e >= start + len(wording) - 2 for n, s, e in spans.get(i, [])), (i, name, spans.get(i))
    assert not any(d >= 1000 for d in spans)


def test_wording_decides(spark):
    gpl = licenses.TEMPLATES["gpl-3.0"]
    rows = [(1, gpl.replace("License", "Licence"), ""), (2, gpl.replace("GNU General", "Very Special"), ""), (3, "All rights are reserved.", ""),
            (4, "Copyright 2020. All rights reserved. Licensed under CC BY-NC 4.0. Released under the MIT License.", "")]
    got = [(d, n) for d, n, *_ in found(spark, rows)]
    assert got == [(1, "gpl-3.0"), (4, "all-rights-reserved"), (4, "cc-by-nc-4.0"), (4, "mit")]
    r = licenses.scan(spark.createDataFrame(rows[:1], "doc_id long, text string, license string")).first()
    assert (r.missing, r.added) == (["license"], ["licence"]) and r.size_primed < r.size_alone


def test_candidates_lose_nothing_against_all_windows():
    """Every notice that is confirmed in some window of any line is found through the anchors as well."""
    rng = random.Random(2)
    scanner = licenses.Scanner(licenses.TEMPLATES)
    words = "a b licensed the under rights reserved mit license version cc all".split()
    for _ in range(60):
        parts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 150))) for _ in range(4)]
        parts.insert(rng.randint(0, 4), licenses.TEMPLATES[rng.choice(["mit", "apache-2.0", "cc-by-nc-4.0"])])
        text = rng.choice(["\n", " "]).join(parts)
        got = {h[0] for h in scanner.scan(text, licenses.ANCHORS)}
        low = [w for w, _, _ in licenses.words(text.split("\n")[0] if "\n" not in text else text)]
        exact = {n for n in licenses.TEMPLATES if f" {' '.join(scanner.words[n])} " in f" {' '.join(low)} "}
        assert {n for n in exact if n != "all-rights-reserved"} <= got | {"apache-2.0-header"}, (exact, got)


def test_edges(spark):
    mit = licenses.TEMPLATES["mit"]
    rows = [(1, None, None), (2, "", ""), (None, mit, "x"), (3, mit, ""), (3, mit, ""), (4, "İ" * 50 + " " + mit + " " + "w " * 100_000, "")]
    got = found(spark, rows)
    assert [g[0] for g in got] == [3, 3, 4, None] and all(g[4] == mit for g in got)
    df = spark.createDataFrame(rows, "doc_id long, text string, license string")
    assert licenses.scan(df.limit(0)).isEmpty()


def test_wrapped_notices_are_found_whole(spark):
    """Every template as it stands in files: broken into short lines, indented, and behind marks of comments."""
    rows, want = [], []
    for name, wording in sorted(licenses.TEMPLATES.items()):
        for width in (20, 70):
            for mark in ("", "    ", " * ", "# ", "// "):
                wrapped = textwrap.wrap(wording, width, break_long_words=False, break_on_hyphens=False)
                notice = f"\n{mark}".join(wrapped)
                text = f"{mark}Copyright 2020\n{mark}\n{mark}{notice}\n\nint main() {{ return 0; }}\n"
                want.append((len(rows), name, notice.rstrip(".:")))
                rows.append((len(rows), text, ""))
    got = [(d, n, notice.rstrip(".:")) for d, n, _, _, notice in found(spark, rows)]
    assert sorted(got) == sorted(want)


def test_anchors_broken_by_white_space(spark):
    rows = [(i, f"Copyright 2020. All rights{gap}reserved.", "") for i, gap in enumerate(["\n", "  ", "\r\n", "\t", "\u00a0", "\n * "])]
    assert [(d, n) for d, n, *_ in found(spark, rows)] == [(i, "all-rights-reserved") for i in range(len(rows))]


def test_a_longer_excerpt_does_not_hide_a_changed_notice():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    header = licenses.TEMPLATES["mit-header"].split()
    changed = " ".join([*header[:15], "any", *header[15:30], "any", *header[30:45], "any", *header[45:]])
    text = " ".join(header[:25]) + "\n\n" + changed
    assert [h[0] for h in scanner.scan(text, licenses.ANCHORS)] == ["mit-header"]


def test_many_notices_in_one_text():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    text = "\n".join(["All rights reserved."] * 2000 + ["x" * 50_000 + "licens" * 20_000])
    assert len(list(scanner.scan(text, licenses.ANCHORS))) == 2000


def test_whole_texts_with_changed_words_against_all_windows():
    """Every place of the text is tried for every template, by counting equal words; the scanner finds the same notices."""
    rng = random.Random(8)
    scanner = licenses.Scanner(licenses.TEMPLATES)
    other = "some words that no license has between its lines or at its ends".split()

    def brute(text, name):
        """Least number of changed words over all windows of the template's length."""
        own, wanted = [w for w, _, _ in licenses.words(text)], scanner.words[name]
        n = len(wanted)
        return min((sum(a != b for a, b in zip(own[i : i + n], wanted)) for i in range(len(own) - n + 1)), default=n)

    whole = [n for n in licenses.TEMPLATES if n.endswith(("-text", "-notice"))]
    assert len(whole) >= 14
    looked = 0
    for name in whole:
        for share in (0.0, 0.05, 0.09, 0.2):
            tokens = licenses.TEMPLATES[name].split()
            for i in rng.sample(range(1, len(tokens) - 1), int(share * len(tokens))):
                tokens[i] = rng.choice(other)
            text = " ".join([*rng.choices(other, k=30), *tokens, *rng.choices(other, k=300)])
            if not re.search(licenses.anchored(licenses.ANCHORS, r"\W+"), text.lower()):
                continue  # all its anchors are among the changed words
            looked += 1
            changed = brute(text, name)
            hits = [h[0] for h in scanner.scan(text, licenses.ANCHORS)]
            if changed <= licenses.ALLOWED * len(scanner.words[name]):
                better = min(whole, key=lambda n: brute(text, n) / len(scanner.words[n]))
                assert name in hits or better in hits, (name, share, hits)
            else:
                assert name not in hits, (name, share, hits)
    assert looked > 0.9 * 4 * len(whole)


def test_the_wording_that_is_there_is_told_from_its_relatives():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for name, wording in licenses.TEMPLATES.items():
        hits = [h[0] for h in scanner.scan(f"Copyright 2021 Someone\n\n{wording}\n\nint main;", licenses.ANCHORS)]
        assert hits == [name], (name, hits)
