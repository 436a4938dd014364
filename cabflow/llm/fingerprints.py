"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A paragraph is a run of words that ends with a line, behind a word whose own hash
says so (one in four), or after eight words, so that an edit changes only the
paragraphs it touches, however long a text's lines are. Repeated paragraphs of a text are told
apart by their number. Every digest is added to three cells of a sketch (count,
sum of digests, sum of their checks). Subtracting two sketches cancels what the
texts share; peeling cells that hold a single digest recovers the digests that
differ. Where peeling stops early, both texts are sketched anew at four times
the size, until it ends; the likeness is then exact: shared over all digests.

The fingerprint is the sketch of the smallest size, in base 64. All texts of a
batch are sketched and peeled together, as arrays.

Defined results: a null text is empty, and texts of any length are read whole; texts without words are equal to each
other, and share nothing with others; equal texts have equal fingerprints;
repeated rows and rows that share an id stand next to each other, in the order
of their text's hash; rows without an id come last; a single row is its own next
document; an empty table gives an empty table. Other columns pass through ``fingerprint``
and ``compare_versions``, whatever their names; ``against_next`` reads id and text only.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.llm.common import append, fresh_name, int_lists, plus, slices, text_column, utf8
from cabflow.llm.ordered import BUCKET, EDGE, with_edges
from cabflow.llm.shingles import mix, span_hashes, words

FIRST_CELLS = 12
GROWTH = 4
WORDS_PER_PARAGRAPH = 4
MOST_WORDS = 8
BLOCK_CHARS = 4 << 20
_STEP = np.uint64(0xA24BAED4963EE407)
_CHECK = np.uint64(0x9FB21C651E98DF25)


def paragraphs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Digests of all texts' paragraphs, and each text's offset among them; no text holds one twice."""
    data, starts, ends, at = words(texts, lower=False)
    n = len(starts)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    h = span_hashes(data, starts, ends)
    first = np.zeros(n, bool)
    first[at[:-1][at[:-1] < n]] = True
    first[1:] |= (h[:-1] >> np.uint64(40)) % np.uint64(WORDS_PER_PARAGRAPH) == 0
    lines = np.searchsorted(np.flatnonzero(data == 10), starts)
    first[1:] |= lines[1:] != lines[:-1]
    begin = np.flatnonzero(first)
    place = np.arange(n) - np.repeat(begin, np.diff(np.r_[begin, n]))
    first |= place % MOST_WORDS == 0
    begin, place = np.flatnonzero(first), place % MOST_WORDS
    weight = np.multiply.accumulate(np.r_[np.uint64(1), np.full(int(place.max()), _STEP, np.uint64)])
    digests = mix(np.add.reduceat(h * weight[place], begin))
    offsets = np.searchsorted(begin, at)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    order = np.lexsort((digests, owner))
    d, o = digests[order], owner[order]
    new = np.r_[True, (d[1:] != d[:-1]) | (o[1:] != o[:-1])]
    run = np.flatnonzero(new)
    number = np.arange(len(d)) - np.repeat(run, np.diff(np.r_[run, len(d)]))
    again = number > 0
    d[again] = mix(d[again] + number[again].astype(np.uint64) * _STEP)
    return d, offsets


class Sketches:
    """One sketch of ``cells`` cells for each of ``n`` texts."""

    def __init__(self, n: int, cells: int):
        self.cells = cells
        self.count = np.zeros(n * cells, np.int32)
        self.total = np.zeros(n * cells, np.uint64)
        self.check = np.zeros(n * cells, np.uint64)

    def add(self, owner: np.ndarray, digests: np.ndarray, sign: int | np.ndarray = 1) -> None:
        signed = np.broadcast_to(np.asarray(sign, np.int64), digests.shape).astype(np.uint64)
        check = mix(digests ^ _CHECK) * signed
        for place in self.places(owner, digests):
            np.add.at(self.count, place, signed.astype(np.int32))
            np.add.at(self.total, place, digests * signed)
            np.add.at(self.check, place, check)

    def places(self, owner: np.ndarray, digests: np.ndarray) -> Iterator[np.ndarray]:
        third = self.cells // 3
        for j in range(3):
            seed = np.uint64((self.cells * 8 + j + 1) * int(_STEP) % 2**64)
            yield owner * self.cells + j * third + (mix(digests ^ seed) % np.uint64(third)).astype(np.int64)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(owner, digest, sign) of all that could be recovered; what is left stays in the cells."""
        found: list[tuple] = []
        look = np.flatnonzero(self.count)
        while len(look):
            count = self.count[look]
            sign = np.where(count < 0, np.uint64(2**64 - 1), np.uint64(1))
            digests = self.total[look] * sign
            pure = (np.abs(count) == 1) & (mix(digests ^ _CHECK) * sign == self.check[look])
            if not pure.any():
                break
            owner, digests, signs = look[pure] // self.cells, digests[pure], count[pure].astype(np.int64)
            one = _distinct(owner, digests)
            owner, digests, signs = owner[one], digests[one], signs[one]
            self.add(owner, digests, -signs)
            found.append((owner, digests, signs))
            touched = np.unique(np.concatenate(list(self.places(owner, digests))))
            look = touched[self.count[touched] != 0]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def left(self) -> np.ndarray:
        """Whether each text's cells still hold anything."""
        some = (self.count != 0) | (self.total != 0) | (self.check != 0)
        return some.reshape(-1, self.cells).any(axis=1)

    def strings(self) -> list[str]:
        """Each sketch as text: its cells' counts (32 bits), sums and checks (64 bits), little-endian, in base 64."""
        n = len(self.count) // self.cells
        parts = [x.reshape(n, self.cells) for x in (self.count.astype("<i4"), self.total.astype("<u8"), self.check.astype("<u8"))]
        return [base64.b64encode(b"".join(p[i].tobytes() for p in parts)).decode() for i in range(n)]


def _distinct(owner: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Indices of one of each (owner, digest): a digest is often alone in several of its cells."""
    order = np.lexsort((digests, owner))
    d, o = digests[order], owner[order]
    return order[np.r_[True, (d[1:] != d[:-1]) | (o[1:] != o[:-1])]]


def sketch(digests: np.ndarray, offsets: np.ndarray, cells: int = FIRST_CELLS) -> Sketches:
    out = Sketches(len(offsets) - 1, cells)
    out.add(np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)), digests)
    return out


def differences(
    a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], cells: int = FIRST_CELLS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, digest, sign) of all digests that only one of each pair's two texts holds: 1 the first, -1 the second."""
    n = len(a[1]) - 1
    open_ = np.arange(n)
    found: list[tuple] = []
    sides = [(d, at, np.repeat(np.arange(n), np.diff(at))) for d, at in (a, b)]
    while len(open_):
        slot = np.full(n, -1)
        slot[open_] = np.arange(len(open_))
        diff = Sketches(len(open_), cells)
        for (digests, _, owner), sign in zip(sides, (1, -1), strict=True):
            mine = slot[owner] >= 0
            diff.add(slot[owner[mine]], digests[mine], sign)
        pair, digests, signs = diff.peel()
        stuck = diff.left()
        done = ~stuck[pair]
        found.append((open_[pair[done]], digests[done], signs[done]))
        open_, cells = open_[stuck], cells * GROWTH
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Shared digests over all digests of each pair of texts."""
    n_a, n_b = np.diff(a[1]), np.diff(b[1])
    differ = np.bincount(differences(a, b)[0], minlength=len(n_a))
    return np.where(n_a + n_b == 0, 1.0, (n_a + n_b - differ) / np.maximum(1, n_a + n_b + differ))


def picked(units: tuple[np.ndarray, np.ndarray], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The digests of some texts."""
    digests, at = units
    sizes = np.diff(at)[rows]
    parts = [digests[at[i] : at[i + 1]] for i in rows]
    return (np.concatenate(parts) if parts else digests[:0]), np.r_[0, np.cumsum(sizes)]


def fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``df`` with each whole text's fingerprint; a name that is taken gets an underscore more."""
    out = fresh_name(df.columns, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            yield append(batch, [out], [pa.array(sketch(*paragraphs(text_column(batch, text))).strings(), pa.string())])

    return df.mapInArrow(run, plus(df.schema, T.StructField(out, T.StringType())))


def compare_versions(df: DataFrame, old: str, new: str) -> DataFrame:
    """``df`` with ``removed`` and ``added`` paragraph digests (arrays of long) and ``likeness`` of two texts a row.

    A name that is taken gets an underscore more.
    """
    names = [fresh_name(df.columns, n) for n in ("removed", "added", "likeness")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, old):
            a, b = paragraphs(text_column(batch, old)), paragraphs(text_column(batch, new))
            pair, digests, signs = differences(a, b)
            lists = []
            for sign in (1, -1):
                of, own = pair[signs == sign], digests[signs == sign].astype(np.int64)
                order = np.lexsort((own, of))
                bounds = np.searchsorted(of[order], np.arange(batch.num_rows + 1))
                lists.append(int_lists(own[order], bounds, pa.int64()))
            yield append(batch, names, [*lists, pa.array(likeness(a, b))])

    kinds = [T.ArrayType(T.LongType()), T.ArrayType(T.LongType()), T.DoubleType()]
    fields = [T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]
    return df.mapInArrow(run, plus(df.schema, *fields))


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the following one's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = "{key} {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def against_next(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and its edited one, and the likeness to that and to the next document.

    The next document is the one with the next smaller id; the largest follows the smallest.
    """
    own = F.col(f"`{key}`").cast("long")
    rows = df.select(
        own.alias(key),
        F.coalesce(F.bitwise_not(own), F.lit(2**63 - 1)).alias("_k"),  # descending; no id: last
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"),
    )
    ordered = with_edges(rows.withColumn("_tie", F.xxhash64("_text")), "_k", "_tie", cyclic=True)
    return ordered.mapInArrow(_stream(key), RESULT.format(key=f"`{key}`", kind="long"))


def _stream(key: str):
    def result(ids: list, texts: list[str], pairs: list[int]) -> pa.RecordBatch:
        """Rows for texts i and i + 1 of each i in ``pairs``."""
        at = np.array(pairs)
        column = pa.array(texts, pa.large_string())
        units = paragraphs(column)
        new = [edited(texts[i], texts[i + 1]) for i in pairs]
        new_units = paragraphs(pa.array(new, pa.large_string()))
        old_units = picked(units, at)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([ids[i] for i in pairs], pa.int64()),
                pa.array([len(texts[i]) for i in pairs], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
                pa.array(sketch(*old_units).strings(), pa.string()),
                pa.array(sketch(*new_units).strings(), pa.string()),
                pa.array(likeness(old_units, new_units)),
                pa.array(likeness(old_units, picked(units, at + 1))),
            ],
            names=[key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        pairs: list[int] = []
        size, bucket, closed = 0, None, True
        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            places = zip(col[BUCKET].to_pylist(), col[EDGE].to_pylist(), col[key].to_pylist(), strict=True)
            for i, (b, edge, one) in enumerate(places):
                if b != bucket:
                    bucket, closed = b, True  # the first row follows none of this bucket
                elif closed:
                    continue  # a further row with the key that follows the bucket
                if not closed:
                    pairs.append(len(texts) - 1)
                text = col["_text"][i].as_py()
                ids.append(one)
                texts.append(text)
                size += len(text)
                closed = edge != 0
                if size >= BLOCK_CHARS and pairs:
                    yield result(ids, texts, pairs)
                    ids, texts, pairs, size = ids[-1:], texts[-1:], [], len(texts[-1])
        if pairs:
            yield result(ids, texts, pairs)

    return run
