"""Vector bin packing of tokenised examples under limits on tokens, segments and loss-bearing tokens.

Each text's ids (plus an end id) are cut into pieces of a sequence's length; a
piece of full length is a sequence by itself. The rest of each text, an item, is
dealt out evenly over tasks by the hash of what it holds (and, of rows that are equal
in all, by how many the task before had already seen), and every task fills
sequences by the dot-product heuristic: of all items that fit, take the one whose
demand (tokens, one segment, loss-bearing tokens, each as a share of its limit)
has the largest dot product with what the sequence has left. Where none fits
whole, the smallest item too long is cut to fill the sequence exactly and its
rest is an item again. What a task has left at its end, under one sequence, is
cut into sequences of powers of two, which need no padding.

A task holds the items of one block (``BLOCK_ITEMS``) at a time, so memory does
not grow with the input. ``sequence_id`` is the task's number and a running
number in it; any attempt of a task packs all its items, whatever their order.

The limit on segments is by default that on tokens, which no item can reach before it, so
that short items fill their sequences; a smaller one leaves padding where items are
shorter than ``capacity / max_segments`` on average, as no packing of whole and cut items
can avoid.

Defined results: of items with equal dot products any may come first; null or empty text has the end id alone; a null ``loss_from``
counts as 0; a text of any length; repeated rows are packed each for itself; an
empty table gives an empty table; other columns pass through, and a new column
whose name is taken gets an underscore more.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.llm.common import fresh_name, shuffle_partitions, slices, text_column
from cabflow.llm.tokens import text_encoder

BLOCK_ITEMS = 50_000
NEW = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")


def pack(
    df: DataFrame,
    path: str,
    text: str = "text",
    loss_from: str | None = None,
    capacity: int = 1024,
    max_segments: int | None = None,
    max_loss: int | None = None,
    end_id: int = 0,
    keep_ids: bool = True,
) -> DataFrame:
    """Pieces of all texts with their places in sequences.

    ``loss_from`` names a column with the first token that bears loss (a prompt's
    length); without it all do. The result has the other columns of ``df``, the
    piece's ``start`` among its text's ids, ``length``, ``ids_crc32`` (of the ids
    as little-endian unsigned 32-bit numbers), ``doc_tokens``, ``sequence_id``,
    ``offset`` there, and with ``keep_ids`` its ``ids`` as such numbers.
    """
    max_loss = capacity if max_loss is None else max_loss
    max_segments = capacity if max_segments is None else max_segments
    if not 0 < max_loss or not 0 < max_segments or not 0 < capacity:
        raise ValueError("limits must be positive")
    others = [c for c in df.columns if c != text]
    names = {n: fresh_name(others, n) for n in (*NEW, "_loss_from", "_full", "_same", "_seen")}
    first = F.greatest(F.coalesce(F.col(loss_from).cast("long"), F.lit(0)), F.lit(0)) if loss_from else F.lit(0)
    hashable = [c for c in others if _hashable(df, c)]
    rows = df.withColumn(names["_loss_from"], first.cast("long"))
    rows = rows.withColumn(names["_same"], F.xxhash64(F.lit(0), *[F.col(f"`{c}`") for c in hashable]))
    fields = [df.schema[c] for c in others]
    long = lambda n: T.StructField(names[n], T.LongType())
    piece = T.StructType(
        [*fields, long("start"), long("length"), long("ids_crc32"), long("doc_tokens"), long("_loss_from"),
         T.StructField(names["_full"], T.BooleanType()), T.StructField(names["ids"], T.BinaryType()), long("_same"), long("_seen")]
    )
    cut = rows.mapInArrow(_cut(path, text, others, names, capacity, max_loss, end_id, keep_ids), piece)
    # Equal rows differ in ``_seen``, which any attempt of a task gives to the same number of them.
    spread = cut.repartition(shuffle_partitions(df.sparkSession), names["ids_crc32"], names["start"], names["_same"], names["_seen"])
    spread = spread.drop(names["_same"], names["_seen"])
    placed = T.StructType(
        [*fields, *[long(n) for n in NEW[:-1]], *([T.StructField(names["ids"], T.BinaryType())] if keep_ids else [])]
    )
    return spread.mapInArrow(_place(others, names, capacity, max_segments, max_loss, keep_ids), placed)


def _hashable(df: DataFrame, column: str) -> bool:
    return "map" not in df.schema[column].dataType.simpleString() and "variant" not in df.schema[column].dataType.simpleString()


def _cut(path, text, others, names, capacity, max_loss, end_id, keep_ids):
    full = min(capacity, max_loss)  # a piece of this length keeps the limits whatever of it bears loss

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path)
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 32
        met: dict[tuple, int] = {}  # how many equal pieces this task has had
        for batch in slices(batches, text):
            flat, offsets = encoder.encode(text_column(batch, text))
            flat = flat.astype("<u4")
            loss = batch.column(batch.schema.get_field_index(names["_loss_from"])).to_pylist()
            same = batch.column(batch.schema.get_field_index(names["_same"])).to_pylist()
            row, start, length, crc, total, is_full, raw, seen = [], [], [], [], [], [], [], []
            end = np.array([end_id], "<u4").tobytes()
            for i in range(batch.num_rows):
                data = flat[offsets[i] : offsets[i + 1]].tobytes() + end
                n = len(data) // 4
                for a in range(0, n, full):
                    part = data[4 * a : 4 * (a + full)]
                    whole = len(part) == 4 * full == 4 * capacity
                    row.append(i)
                    start.append(a)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    piece = (same[i], a, crc[-1])
                    seen.append(number + met.get(piece, 0))
                    met[piece] = met.get(piece, 0) + 1
                    total.append(n)
                    is_full.append(whole)
                    raw.append(part if keep_ids or not whole else None)
            taken = pa.array(row, pa.int64())
            columns = [batch.column(batch.schema.get_field_index(c)).take(taken) for c in others]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            columns += [pa.array([loss[i] for i in row], pa.int64()), pa.array(is_full, pa.bool_()), pa.array(raw, pa.binary())]
            columns += [pa.array([same[i] for i in row], pa.int64()), pa.array(seen, pa.int64())]
            keys = [names[n] for n in ("start", "length", "ids_crc32", "doc_tokens", "_loss_from", "_full", "ids", "_same", "_seen")]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, *keys])

    return run


class Shelf:
    """Items to be packed, by their class (length, loss-bearing tokens)."""

    def __init__(self, capacity: int, max_segments: int, max_loss: int):
        self.limits = np.array([capacity, max_segments, max_loss], float)
        self.at: dict[tuple[int, int], int] = {}
        self.items: list[list] = []
        self.length = np.zeros(1024, np.int64)
        self.loss = np.zeros(1024, np.int64)
        self.held = np.zeros(1024, bool)
        self.count = 0

    def put(self, ref, start: int, length: int, loss_from: int) -> None:
        loss = max(0, start + length - max(start, loss_from))
        k = self.at.get((length, loss))
        if k is None:
            k = self.at[length, loss] = len(self.items)
            self.items.append([])
            if k == len(self.length):
                self.length, self.loss, self.held = (np.concatenate([x, np.zeros_like(x)]) for x in (self.length, self.loss, self.held))
            self.length[k], self.loss[k] = length, loss
        self.items[k].append((ref, start, length, loss_from))
        self.held[k] = True
        self.count += 1

    def _take(self, k: int):
        item = self.items[k].pop()
        self.held[k] = bool(self.items[k])
        self.count -= 1
        return item

    def best(self, left: np.ndarray):
        """The fitting item with the largest dot product of demand and what is left, or None."""
        n = len(self.items)
        fits = self.held[:n] & (self.length[:n] <= left[0]) & (self.loss[:n] <= left[2])
        if left[1] < 1 or not fits.any():
            return None
        share = left / self.limits
        score = self.length[:n] * (share[0] / self.limits[0]) + self.loss[:n] * (share[2] / self.limits[2])
        return self._take(int(np.argmax(np.where(fits, score, -1.0))))

    def too_long(self, left: np.ndarray):
        """The item to cut: the shortest that is longer than what is left, or else the shortest."""
        n = len(self.items)
        if left[1] < 1 or left[0] < 1 or not self.count:
            return None
        lengths = np.where(self.held[:n], self.length[:n], np.iinfo(np.int64).max)
        longer = np.where(lengths > left[0], lengths, np.iinfo(np.int64).max)
        k = int(np.argmin(longer))
        return self._take(k if longer[k] < np.iinfo(np.int64).max else int(np.argmin(lengths)))


def fill(shelf: Shelf, enough: int = 0) -> Iterator[list]:
    """Sequences, as lists of (ref, start, length, loss_from), until at most ``enough`` items are left."""
    while shelf.count > enough:
        left, out = shelf.limits.copy(), []
        while left[0] > 0 and left[1] > 0:
            item = shelf.best(left)
            if item is None:
                item = shelf.too_long(left)
                if item is None:
                    break
                ref, start, length, loss_from = item
                before = max(0, min(length, loss_from - start))  # tokens without loss come first
                n = int(min(length, left[0], before + left[2]))
                if n <= 0:
                    shelf.put(*item)
                    break
                if n < length:
                    shelf.put(ref, start + n, length - n, loss_from)
                item = (ref, start, n, loss_from)
            _, start, length, loss_from = item
            out.append(item)
            left -= (length, 1, max(0, start + length - max(start, loss_from)))
        if not out:
            raise ValueError("an item fits no sequence")
        yield out


def powers_of_two(sequence: list) -> Iterator[list]:
    """A short sequence cut into ones whose lengths are the powers of two in its own."""
    size = sum(x[2] for x in sequence)
    todo = list(reversed(sequence))
    for bit in reversed(range(size.bit_length())):
        want, out = size & (1 << bit), []
        while want:
            ref, start, length, loss_from = todo.pop()
            n = min(want, length)
            out.append((ref, start, n, loss_from))
            if n < length:
                todo.append((ref, start + n, length - n, loss_from))
            want -= n
        if out:
            yield out


def _place(others, names, capacity, max_segments, max_loss, keep_ids):
    keys = [*others, *[names[n] for n in NEW[:-1]], *([names["ids"]] if keep_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 32
        shelf, tables, held = Shelf(capacity, max_segments, max_loss), {}, 0

        def column(batch, name):
            return batch.column(batch.schema.get_field_index(names[name]))

        def rows_of(sequences) -> pa.RecordBatch | None:
            """Rows of packed sequences."""
            nonlocal number
            refs, out = [], {n: [] for n in NEW}
            for sequence in sequences:
                at = 0
                for (t, i), start, length, _ in sequence:
                    first, data, _ = tables[t][1][i]
                    part = data[4 * (start - first) : 4 * (start - first + length)]
                    refs.append((t, i))
                    out["start"].append(start)
                    out["length"].append(length)
                    out["ids_crc32"].append(zlib.crc32(part))
                    out["doc_tokens"].append(tables[t][1][i][2])
                    out["sequence_id"].append(number)
                    out["offset"].append(at)
                    out["ids"].append(part)
                    at += length
                number += 1
            if not refs:
                return None
            # Rows of several input batches: taken from each, then put in order.
            order, parts = [], {}
            for k, (t, i) in enumerate(refs):
                parts.setdefault(t, []).append((k, i))
            pieces = []
            for t, some in parts.items():
                order += [k for k, _ in some]
                pieces.append(tables[t][0].take(pa.array([i for _, i in some], pa.int64())))
            back = pa.array(np.argsort(np.array(order), kind="stable"))
            columns = [pa.concat_arrays([p.column(j) for p in pieces]).take(back) for j in range(len(others))]
            columns += [pa.array(out[n], pa.int64()) for n in NEW[:-1]]
            if keep_ids:
                columns.append(pa.array(out["ids"], pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=keys)

        def by_thousands(sequences):
            some = []
            for s in sequences:
                some.append(s)
                if len(some) == 1000:
                    yield rows_of(some)
                    some = []
            if some:
                yield rows_of(some)

        for t, batch in enumerate(batches):
            whole = column(batch, "_full").to_numpy(zero_copy_only=False)
            alone = np.flatnonzero(whole)
            if len(alone):
                part = batch.take(pa.array(alone))
                ids = pa.array(np.arange(number, number + len(alone)), pa.int64())
                number += len(alone)
                columns = [part.column(part.schema.get_field_index(c)) for c in others]
                columns += [column(part, n) for n in ("start", "length", "ids_crc32", "doc_tokens")]
                columns += [ids, pa.array(np.zeros(len(alone)), pa.int64())]
                if keep_ids:
                    columns.append(column(part, "ids"))
                yield pa.RecordBatch.from_arrays(columns, names=keys)
            rest = np.flatnonzero(~whole)
            if not len(rest):
                continue
            part = batch.take(pa.array(rest))
            start, length, total, loss, data = (column(part, n).to_pylist() for n in ("start", "length", "doc_tokens", "_loss_from", "ids"))
            # Only the other columns and the ids of items still on the shelf are kept.
            tables[t] = (pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(c)) for c in others], names=others) if others else part.select([]),
                         [(a, d, n) for a, d, n in zip(start, data, total, strict=True)])
            for i in range(len(rest)):
                shelf.put((t, i), start[i], length[i], loss[i])
            held += len(rest)
            if held > BLOCK_ITEMS:
                yield from by_thousands(fill(shelf, BLOCK_ITEMS // 10))
                live = {x[0][0] for items in shelf.items for x in items}
                for old in [k for k in tables if k not in live]:
                    del tables[old]
                held = shelf.count
        done = list(fill(shelf))
        if done and sum(x[2] for x in done[-1]) < capacity:
            done[-1:] = list(powers_of_two(done[-1]))
        yield from by_thousands(done)

    return run
