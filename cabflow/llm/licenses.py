"""License notices in documents, by conditional compression.

Every template holds an anchor, a stem. A candidate block is an anchor in a text with
as many words before and after it as the longest template with its allowed
differences has, whatever line breaks, spaces and marks of comments stand between
them. Each block is compressed with every template as a zstandard raw dictionary and
without any; the template that shrinks it most is the first to be confirmed, by its
exact wording: the template's words are aligned with the block's around the anchor,
and the words missing, added or changed within the aligned span may be at most a
tenth of the template's words.
If it is not confirmed, the next template follows. A confirmed span is cut out, and
the next anchor after it has the next block, so that several notices side by side
are all found.

Defined results: null and empty texts hold no notice; texts of any length are
scanned whole; of templates that shrink a block equally, the first in name order
comes first; repeated rows yield repeated notices; an empty table gives an empty
table; other columns pass through, and a new column whose name is taken gets an
underscore more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.llm.common import fresh_name, once, slices, text_column
from cabflow.llm.license_texts import TEXTS

# Short notices and the first words of public licenses; ``license_texts`` has whole wordings.
TEMPLATES = {
    **TEXTS,
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance'
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "bsd-header": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met:"
    ),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any"
        " later version."
    ),
    "mit": "Released under the MIT License.",
    "mit-header": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction, including without limitation'
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
}
ANCHORS = (
    "licens", "rights reserved", "redistribut", "permission is", "permission to use", "creative commons", "unencumbered software",
    "merchantab", "express or implied warrant",
)
LEVEL = 3
ALLOWED = 0.1
GAP = r"[^\p{L}\p{N}_]+"  # Java's form of \W+
_WORD = re.compile(r"\S+")
_EDGE = re.compile(r"^\W+|\W+$")


def words(text: str, start: int = 0, end: int | None = None) -> list[tuple[str, int, int]]:
    """Plain words of a text with their spans: lower case, without punctuation at their ends."""
    return list(_words(text, start, len(text) if end is None else end))


def _words(text: str, start: int, end: int) -> Iterator[tuple[str, int, int]]:
    found = ((_EDGE.sub("", m[0]).lower(), m.start(), m.end()) for m in _WORD.finditer(text, start, end))
    return (w for w in found if w[0])


def words_before(text: str, low: int, at: int, n: int) -> list[tuple[str, int, int]]:
    """The last ``n`` plain words between two places, the second of which starts a word."""
    size = 16 * n
    while True:
        start = max(low, at - size)
        found = words(text, start, at)
        if start == low:
            return found[-n:]
        if found and found[0][1] == start and not text[start - 1].isspace():  # the end of a longer word
            del found[0]
        if len(found) >= n:
            return found[-n:]
        size *= 4


class Scanner:
    def __init__(self, templates: dict[str, str], allowed: float = ALLOWED):
        import zstandard as zstd

        self.names = sorted(templates)
        self.plain = zstd.ZstdCompressor(level=LEVEL)
        self.primed, self.words, self.pieces = {}, {}, {}
        for name in self.names:
            raw = zstd.ZstdCompressionDict(templates[name].lower().encode(), dict_type=zstd.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=LEVEL)
            self.primed[name] = zstd.ZstdCompressor(level=LEVEL, dict_data=raw)
            wanted = self.words[name] = [w for w, _, _ in words(templates[name])]
            n = min(int(allowed * len(wanted)) + 1, len(wanted))
            cuts = [len(wanted) * i // n for i in range(n + 1)]
            self.pieces[name] = [(a, wanted[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        self.allowed = allowed
        self.reach = max((len(w) + int(allowed * len(w)) + 1 for w in self.words.values()), default=1)

    def ranked(self, block: str) -> list[tuple[int, int, str]]:
        """(size alone, size with the template, name) of each template, the one that shrinks the block most first."""
        raw = block.lower().encode()
        alone = len(self.plain.compress(raw))
        # In a long block a short notice may save nothing, so none is ruled out by size alone.
        sizes = [(alone, len(self.primed[n].compress(raw)), n) for n in self.names]
        return sorted(sizes, key=lambda x: (x[1], x[2]))

    def aligned(
        self, name: str, block: list[str], where: dict[str, list[int]], anchor: range
    ) -> tuple[int, int, list[str], list[str]] | None:
        """(first word, last word + 1, missing, added) of the template's wording around the anchor's words, or None.

        ``where`` has the places of each word of the block. Of as many pieces as there
        may be differences, and one more, one at least is unchanged, so that all places
        the wording can have are looked at.
        """
        wanted = self.words[name]
        reach = int(self.allowed * len(wanted)) + 1
        places = sorted(
            {i - at for at, piece in self.pieces[name] for i in where.get(piece[0], ()) if block[i : i + len(piece)] == piece}
        )
        best = None
        for place in places:
            if place - reach >= anchor.stop or place + len(wanted) + reach <= anchor.start:
                continue
            start, end = max(0, place - reach), min(len(block), place + len(wanted) + reach)
            codes = SequenceMatcher(None, wanted, block[start:end], autojunk=False).get_opcodes()
            same = [c for c in codes if c[0] == "equal"]
            first, last = same[0][3], same[-1][4]
            missing, added, differ = [], [], 0
            for kind, a, b, c, d in codes:
                if kind != "equal":
                    c, d = max(c, first), min(d, last)  # words before and after the wording are not part of it
                    missing += wanted[a:b]
                    added += block[start + c : start + d]
                    differ += max(b - a, d - c)
            if differ > self.allowed * len(wanted) or start + first >= anchor.stop or start + last <= anchor.start:
                continue
            if best is None or differ < best[0]:
                best = differ, (start + first, start + last, missing, added)
        return best and best[1]

    def scan(self, text: str, anchors: tuple[str, ...]) -> Iterator[tuple]:
        """(name, start, end, size alone, size with the template, missing, added) of each notice, in text order."""
        low = text.lower()
        if len(low) != len(text):  # a letter whose lower case is longer: places must stay those of the text
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        done = seen = 0  # ends of the last notice, and of the last word whose anchor was looked at
        for m in re.finditer(anchored(anchors, r"\W+"), low):
            at = m.start()
            if at < max(done, seen):
                continue
            while at > done and not text[at - 1].isspace():
                at -= 1
            before = words_before(text, done, at, self.reach)
            after, held = [], 0
            for w in _words(text, at, len(text)):
                after.append(w)
                held += w[1] < m.end()
                if len(after) >= held + self.reach:
                    break
            seen = after[0][2] if held else m.end()
            hit = self._confirmed(text, before + after, range(len(before), len(before) + max(1, held)))
            if hit:
                yield hit
                done = hit[2]

    def _confirmed(self, text: str, spans: list[tuple[str, int, int]], anchor: range) -> tuple | None:
        plain = [w for w, _, _ in spans]
        where: dict[str, list[int]] = {}
        for i, w in enumerate(plain):
            where.setdefault(w, []).append(i)
        for alone, primed, name in self.ranked(" ".join(text[a:b] for _, a, b in spans)):
            hit = self.aligned(name, plain, where, anchor)
            if hit:
                first, last, missing, added = hit
                return name, spans[first][1], spans[last - 1][2], alone, primed, missing, added
        return None


def anchored(anchors: tuple[str, ...], gap: str) -> str:
    """A pattern of the anchors; between their words, anything that is no part of a word."""
    return "|".join(gap.join(map(re.escape, a.split())) for a in anchors)


def _scanner(templates: tuple, allowed: float) -> Scanner:
    return once(("scanner", templates, allowed), lambda: Scanner(dict(templates), allowed))


NEW = ("license", "start", "end", "size_alone", "size_primed", "missing", "added", "notice")


def scan(
    df: DataFrame,
    text: str = "text",
    templates: dict[str, str] | None = None,
    anchors: tuple[str, ...] = ANCHORS,
    allowed: float = ALLOWED,
) -> DataFrame:
    """One row for each notice: the other columns of ``df``, the license, its span, sizes, differing words and wording."""
    templates = TEMPLATES if templates is None else templates
    for name, wording in templates.items():
        if not re.search(anchored(anchors, r"\W+"), wording.lower()):
            raise ValueError(f"template {name} holds no anchor")
    others = [c for c in df.columns if c != text]
    names = [fresh_name(others, n) for n in NEW]
    kinds = [T.StringType(), *[T.LongType()] * 4, *[T.ArrayType(T.StringType())] * 2, T.StringType()]
    arrow = [pa.string(), *[pa.int64()] * 4, *[pa.list_(pa.string())] * 2, pa.string()]
    schema = T.StructType([*[df.schema[c] for c in others], *[T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]])
    frozen = tuple(sorted(templates.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(frozen, allowed)
        for batch in slices(batches, text):
            rows, found = [], []
            for i, t in enumerate(text_column(batch, text).to_pylist()):
                for hit in scanner.scan(t, anchors):
                    rows.append(i)
                    found.append((*hit, t[hit[1] : hit[2]]))
            taken = pa.array(rows, pa.int64())
            columns = [batch.column(batch.schema.get_field_index(c)).take(taken) for c in others]
            columns += [pa.array([f[j] for f in found], k) for j, k in enumerate(arrow)]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, *names])

    # Texts without any anchor hold no candidate block: a cheap test in the JVM before any text goes to Python.
    held = F.lower(F.col(f"`{text}`")).rlike(anchored(anchors, GAP))
    return df.filter(F.coalesce(held, F.lit(False))).mapInArrow(run, schema)
