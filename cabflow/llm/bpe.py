"""BPE encoding and decoding of whole texts, with tree concatenation for long ones.

A text longer than ``leaf_chars`` is cut into halves, quarters and so on; the
pieces become rows of their own, are spread over the cluster and encoded in
parallel. Neighbours are then joined up the tree: a window of tokens around the
join is encoded anew and grown, twofold at a time, until its first tokens agree
with the left side's and one of its tokens agrees with the right side's, in id
and place. Where two encodings share a token, all pairs of neighbouring tokens
left of it stand in the one and all right of it in the other; a BPE encoding is
determined by its neighbouring pairs, so the joined ids are those of the whole
text. A window that never agrees grows to both sides whole, which is exact too.

Defined results: null text is empty and has no ids; any text length; repeated
rows stay repeated; an empty table gives an empty table; other columns pass
through, and a new column whose name is taken gets an underscore more.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.llm.common import append, fresh_name, int_lists, once, plus, shuffle_partitions, slices, text_column
from cabflow.llm.tokens import decoder, tokenizer, text_encoder

LEAF_CHARS = 65_536
ENCODE_BYTES = 2 << 20
FIRST_WINDOW = 4
_SPACE = frozenset(" \t\n\r")


def encode(
    df: DataFrame,
    path: str,
    text: str = "text",
    ids: str = "ids",
    leaf_chars: int = LEAF_CHARS,
    decoded: str | None = None,
) -> DataFrame:
    """``df`` with the ids of each text as an array<int>, as the tokenizer at ``path`` gives them.

    ``decoded`` names a further column with the text that the ids decode to, for a
    round trip in one pass: the ids need not go to the JVM and back for it.
    """
    out = fresh_name(df.columns, ids)
    back = fresh_name([*df.columns, out], decoded) if decoded else None
    length = F.coalesce(F.char_length(F.col(text)), F.lit(0))
    fields = [T.StructField(out, T.ArrayType(T.IntegerType())), *([T.StructField(back, T.StringType())] if back else [])]
    short = df.filter(length <= leaf_chars).mapInArrow(_encode_rows(path, text, out, back), plus(df.schema, *fields))
    long = _encode_long(df.filter(length > leaf_chars), path, text, out, leaf_chars)
    return short.unionByName(decode(long, path, out, back) if back else long)


def _encode_rows(path: str, text: str, out: str, back: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path)
        for batch in slices(batches, text, ENCODE_BYTES):
            flat, offsets = encoder.encode(text_column(batch, text))
            batch = append(batch, [out], [int_lists(flat, offsets)])
            if back:
                texts = decoder(path).decode(flat.astype(np.int64), offsets)
                batch = append(batch, [back], [pa.array(texts, pa.string())])
            yield batch

    return run


def _encode_long(df: DataFrame, path: str, text: str, out: str, leaf_chars: int) -> DataFrame:
    """Pieces of long texts, encoded as rows of their own and joined for each text."""
    names = df.columns
    key, leaf, piece = (fresh_name(names, c) for c in ("_key", "_leaf", "_piece"))
    row = fresh_name(names, "_row")
    # Equal rows share a key: their pieces are joined once and the result returned for each.
    packed = df.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias(row),
        F.col(f"`{text}`").alias(piece),
    ).withColumn(key, F.sha2(F.to_json(row), 256))
    leaves = packed.mapInArrow(
        _cut(key, row, piece, leaf, leaf_chars),
        T.StructType(
            [
                T.StructField(key, T.StringType()),
                T.StructField(leaf, T.LongType()),
                T.StructField(piece, T.StringType()),
                T.StructField(row, packed.schema[row].dataType),
            ]
        ),
    )
    spread = leaves.repartition(shuffle_partitions(df.sparkSession), key, leaf)
    lists = T.ArrayType(T.IntegerType())
    coded = spread.mapInArrow(
        _encode_leaves(path, piece),
        plus(spread.schema, *[T.StructField(f"_{c}", lists) for c in ("ids", "starts", "ends")]),
    )
    joined = coded.groupBy(key).applyInArrow(
        _join(path, key, leaf, piece, row, out),
        T.StructType([T.StructField(row, packed.schema[row].dataType), T.StructField(out, lists)]),
    )
    return joined.select(*[F.col(f"`{row}`.`{c}`").alias(c) for c in names], F.col(out))


def safe_cut(text: str, at: int) -> int:
    """The first place from ``at`` on where normalisation cannot join the two sides; the end if none."""
    while at < len(text) and not _starts(text[at]):
        at += 1
    return at


def _starts(c: str) -> bool:
    if ord(c) < 0x300:
        return True
    # Marks and conjoining letters may be composed with what stands before them.
    return not unicodedata.category(c).startswith("M") and not 0x1100 <= ord(c) <= 0x11FF


def cuts(text: str, leaf_chars: int) -> list[int]:
    """Bounds of the pieces: halves of halves until each has at most ``leaf_chars`` (plus a safe cut's shift)."""
    parts = 1
    while len(text) / parts > leaf_chars:
        parts *= 2
    bounds = [0]
    for i in range(1, parts):
        at = safe_cut(text, len(text) * i // parts)
        if bounds[-1] < at < len(text):
            bounds.append(at)
    return [*bounds, len(text)]


def _cut(key: str, row: str, piece: str, leaf: str, leaf_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, piece):
            rows = batch.column(batch.schema.get_field_index(row))
            keys, where, texts, first = [], [], [], []
            names = batch.column(batch.schema.get_field_index(key)).to_pylist()
            for i, (k, text) in enumerate(zip(names, text_column(batch, piece).to_pylist(), strict=True)):
                at = cuts(text, leaf_chars)
                for j in range(len(at) - 1):
                    keys.append(k)
                    where.append(at[j])
                    texts.append(text[at[j] : at[j + 1]])
                    first.append(i if j == 0 else None)  # the row's other columns travel with its first piece only
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.string()),
                    pa.array(where, pa.int64()),
                    pa.array(texts, pa.string()),
                    rows.take(pa.array(first, pa.int64())),
                ],
                names=[key, leaf, piece, row],
            )

    return run


def _encode_leaves(path: str, piece: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, piece):
            coded = [encode_with_places(path, t) for t in text_column(batch, piece).to_pylist()]
            lists = [pa.array([c[i] for c in coded], pa.list_(pa.int32())) for i in range(3)]
            yield append(batch, ["_ids", "_starts", "_ends"], lists)

    return run


def encode_with_places(path: str, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of a text with the first and last place (code points) of each."""
    e = tokenizer(path).encode(text, add_special_tokens=False)
    places = np.array(e.offsets, np.int32).reshape(-1, 2)
    return np.array(e.ids, np.int32), places[:, 0], places[:, 1]


Coded = tuple[str, np.ndarray, np.ndarray, np.ndarray]


def join_pair(path: str, left: Coded, right: Coded, window: int = FIRST_WINDOW) -> Coded:
    """The encoding of two neighbouring pieces' text from those of the pieces."""
    a, ids_a, start_a, end_a = left
    b, ids_b, start_b, end_b = right
    text, m = a + b, len(a)
    rest = (start_b + m, end_b + m)
    if not tokenizer_drops_space(path):
        space_joins = False
    else:
        space_joins = a[-1:] in _SPACE or b[:1] in _SPACE
    if space_joins or not a or not b:
        return text, np.r_[ids_a, ids_b], np.r_[start_a, rest[0]], np.r_[end_a, rest[1]]
    k, margin = window, longest_added(path)
    while True:
        i = max(0, len(ids_a) - k)
        while i > 0 and start_a[i] < end_a[i - 1]:  # not inside a character of several tokens
            i -= 1
        j = min(len(ids_b), k)
        while 0 < j < len(ids_b) and start_b[j] < end_b[j - 1]:
            j += 1
        whole_left, whole_right = i == 0, j == len(ids_b)
        p = 0 if whole_left else int(start_a[i])
        q = len(text) if whole_right else int(rest[0][j])
        ids, start, end = encode_with_places(path, text[p:q])
        start, end = start + p, end + p
        # A special token is matched by its whole string, so none may reach over a window's end.
        fits = whole_left or (m - p >= margin and _agree_left((ids, start, end), (ids_a[i:], start_a[i:], end_a[i:])))
        hit = (len(ids), len(ids_b)) if whole_right else _agree_right((ids, start, end), (ids_b, *rest), m, q - margin)
        if fits and hit is not None:
            x, y = hit
            return (
                text,
                np.r_[ids_a[:i], ids[:x], ids_b[y:]],
                np.r_[start_a[:i], start[:x], rest[0][y:]],
                np.r_[end_a[:i], end[:x], rest[1][y:]],
            )
        k *= 2


def _agree_left(window, side) -> bool:
    """Whether the window's first two tokens are the side's."""
    if len(window[0]) < 2 or len(side[0]) < 2:
        return False
    return all(np.array_equal(w[:2], s[:2]) for w, s in zip(window, side, strict=True))


def _agree_right(window, side, m: int, last_end: int) -> tuple[int, int] | None:
    """Numbers of tokens up to and with the first two in a row, between ``m`` and ``last_end``, that both hold."""
    place = {(int(s), int(e), int(t)): j for j, (t, s, e) in enumerate(zip(*side, strict=True))}
    ids, start, end = window
    last = None
    for x in range(len(ids) - 1):  # the last token may have been cut by the window's end
        j = place.get((int(start[x]), int(end[x]), int(ids[x]))) if start[x] >= m else None
        if j is not None and last is not None and j == last + 1 and end[x] <= last_end:
            return x + 1, j + 1
        last = j
    return None


def longest_added(path: str) -> int:
    """Code points of the longest special token."""
    tokens = once(("added", path), lambda: list(tokenizer(path).get_added_tokens_decoder().values()))
    return max((len(t.content) for t in tokens), default=0)


def tokenizer_drops_space(path: str) -> bool:
    return text_encoder(path).drops_space


def join_tree(path: str, pieces: list[Coded]) -> Coded:
    while len(pieces) > 1:
        pieces = [
            join_pair(path, pieces[i], pieces[i + 1]) if i + 1 < len(pieces) else pieces[i]
            for i in range(0, len(pieces), 2)
        ]
    return pieces[0]


def _join(path: str, key: str, leaf: str, piece: str, row: str, out: str):
    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        number = group[leaf].to_numpy()
        rows = group[row].combine_chunks()
        firsts = np.flatnonzero(number == 0)
        _, order = np.unique(number, return_index=True)  # equal rows: each piece once
        pieces = []
        for i in order.tolist():
            coded = [np.asarray(group[c][i].values.to_numpy(zero_copy_only=False), np.int32) for c in ("_ids", "_starts", "_ends")]
            pieces.append((group[piece][i].as_py(), *coded))
        ids = join_tree(path, pieces)[1]
        lists = pa.array([ids] * len(firsts), pa.list_(pa.field("element", pa.int32())))
        return pa.Table.from_arrays([rows.take(pa.array(firsts)), lists], names=[row, out])

    return run


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of each array of ids, special tokens included (null ids: empty)."""
    name = fresh_name(df.columns, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoder(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                lists = part.column(part.schema.get_field_index(ids))
                sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                texts = table.decode(np.asarray(flat, np.int64), np.r_[0, np.cumsum(sizes)].astype(np.int64))
                yield append(part, [name], [pa.array(texts, pa.string())])

    return df.mapInArrow(run, plus(df.schema, T.StructField(name, T.StringType())))
