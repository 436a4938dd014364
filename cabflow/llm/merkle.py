"""Merkle manifest of a dataset: trees of SHA-256 midstates, proofs and their folding.

A row's leaf is the hash of its columns, each written as its length and value. The leaves of a
group (a language, say) stand in order of their key; every ``FANOUT`` consecutive nodes, or what
is left of them, get a parent, the hash of their digests in hex, until one node is left: the
group's subroot. The subroots, in order of the groups, give the root the same way.

A parent keeps a copy of its hash's state before each child (``sha.py``: the eight words that
the standard's compression leaves after each block). To fold a changed child, the state before its
slot is resumed with the replacement and the children to its right; those to the left are never
hashed again.

In Spark: leaves are hashed and stored, put in order by range partitions (with the row's number as
the last key, so that equal rows fill many partitions), and numbered by the partitions' counts,
without a window over rows. Blocks of ``FANOUT ** LEVELS`` consecutive leaves are one stored row
each, with the digests of their nodes and the states of their parents; blocks' tops are the leaves
of the next round, so that n leaves take log n / log 512 rounds, and no task or driver holds a
tree. On the way back each round gives its members their path to the root: for each level the
slot, the run of sibling digests and the state before the slot. The blocks of leaves, joined with
their paths, give proofs and fold them, many rows at once.

Defined results: null columns are written ``-`` (so null, empty and ``-`` differ); null keys come
first, rows that share a key are in order of their leaf; a null group is a group of its own and
comes first; a lone leaf is its group's subroot, a lone subroot is the root; an empty table gives
no rows; whole texts of any length are hashed in the JVM. Extra columns take no part unless named;
the result has no column of the input but the key, so no name can clash. Values that are no text
are written as Spark casts them to text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.llm import sha
from cabflow.llm.common import shuffle_partitions, stored, unstore

FANOUT, LEVELS = 8, 3
BLOCK = FANOUT**LEVELS
ROWS_AT_ONCE = 8192
FOREST = ""  # the tree of the subroots; trees of leaves have names that begin with "-" or "="

_BLOCK_FIELDS = "tree string, block long, size long, nodes array<binary>, states array<binary>"
_STEP = pa.struct([("slot", pa.int32()), ("run", pa.binary()), ("state", pa.binary())])
_PATH = "array<struct<slot: int, run: binary, state: binary>>"


def leaf_hash(columns: list[Column]) -> Column:
    """Bytes of the hash of ``columns``: each ``-`` if null, else its length in bytes, ``:`` and its value."""
    parts = []
    for c in columns:
        text = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def in_order(df: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``df`` with each row's place ``pos`` in its tree, from 0, and the tree's ``size``.

    Rows go to range partitions; a row's place is its number in its partition and the sum of the
    earlier partitions' counts, of which there is one for each partition and tree.
    """
    sorted_rows = df.repartitionByRange(shuffle_partitions(df.sparkSession), tree, *order).sortWithinPartitions(tree, *order)
    numbered = stored(sorted_rows.withColumn("_place", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftright("_place", 33).alias("_part")
    counts = numbered.groupBy(tree, part).agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
    by_tree = Window.partitionBy(tree)
    earlier = by_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        tree, "_part", "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(by_tree).alias("size"),
    )
    out = numbered.withColumn("_part", F.shiftright("_place", 33)).join(offsets, [tree, "_part"])
    out = out.withColumn("pos", F.col("_place") - F.col("_first") + F.col("_before")).drop("_part", "_place", "_first", "_before")
    out.stored_at = numbered.stored_at
    return out


def parents(digests: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the parents of consecutive runs, and their states before each child slot (n, FANOUT, 32)."""
    counts = np.diff(np.r_[starts, len(digests)])
    state = sha.start(len(starts))
    kept = np.zeros((len(starts), FANOUT, 32), np.uint8)
    blocks = sha.hex_block(digests)
    for slot in range(FANOUT):
        has = np.flatnonzero(counts > slot)
        kept[has, slot] = sha.digests(state[:, has])  # the hash so far, before this child
        state[:, has] = sha.absorb(state[:, has], blocks[:, starts[has] + slot])
    return sha.finished(state, counts), kept


def _whole_blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Rows in tables of about so many, never cut inside a block; rows come sorted by tree and pos."""
    held, count = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held)
        starts = np.flatnonzero(table["pos"].to_numpy() % BLOCK == 0)
        if len(starts) > 1:
            yield table.slice(0, starts[-1])
        at = starts[-1] if len(starts) > 1 else 0
        held, count = table.slice(at).to_batches(), table.num_rows - at
    if count:
        yield pa.Table.from_batches(held)


def _bytes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of 32-byte values without nulls as (n, 32)."""
    flat = column.cast(pa.binary(32))
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    return np.frombuffer(flat.buffers()[1], np.uint8)[flat.offset * 32 : (flat.offset + len(flat)) * 32].reshape(-1, 32)


def _build(members: list[str]):
    """Blocks of sorted leaves: nodes of each level, states of each level's parents, and the members' own columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_blocks(batches, ROWS_AT_ONCE):
            yield _built(table, members)

    return run


def _built(table: pa.Table, members: list[str]) -> pa.RecordBatch:
    pos, size = table["pos"].to_numpy(), table["size"].to_numpy()
    starts = np.flatnonzero(pos % BLOCK == 0)  # of each block's nodes at the level
    digests, node, left = _bytes(table["digest"]), pos % BLOCK, size
    nodes: list[list[bytes]] = [[] for _ in starts]
    states: list[list[bytes]] = [[] for _ in starts]
    owner = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(pos)]))

    def keep(to: list[list[bytes]], values: np.ndarray, owners: np.ndarray) -> None:
        bounds = np.searchsorted(owners, np.arange(len(to) + 1))
        for i in np.flatnonzero(np.diff(bounds)):
            to[i].append(values[bounds[i] : bounds[i + 1]].tobytes())

    keep(nodes, digests, owner)
    for _ in range(LEVELS):
        up = left > 1  # trees that are more than one node
        if not up.any():
            break
        digests, node, left, own = digests[up], node[up], left[up], owner[up]
        runs = np.flatnonzero(node % FANOUT == 0)
        digests, kept = parents(digests, runs)
        node, left, owner = node[runs] // FANOUT, -(-left[runs] // FANOUT), own[runs]
        keep(nodes, digests, owner)
        keep(states, kept, owner)
    offsets = np.r_[starts, len(pos)]
    columns = [
        table["tree"].combine_chunks().take(pa.array(starts)), pa.array(pos[starts] // BLOCK), pa.array(size[starts]),
        pa.array(nodes, pa.list_(pa.binary())), pa.array(states, pa.list_(pa.binary())),
    ]
    for name in members:
        columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), table[name].combine_chunks()))
    return pa.RecordBatch.from_arrays(columns, names=["tree", "block", "size", "nodes", "states", *members])


def _round(leaves: DataFrame, members: list[str]) -> DataFrame:
    """Stored blocks of ``leaves`` (tree, pos, size, digest and members)."""
    kinds = "".join(f", {m} array<{leaves.schema[m].dataType.simpleString()}>" for m in members)
    block = F.floor(F.col("pos") / BLOCK)
    dealt = leaves.repartition(shuffle_partitions(leaves.sparkSession), "tree", block).sortWithinPartitions("tree", "pos")
    return stored(dealt.mapInArrow(_build(members), _BLOCK_FIELDS + kinds), "merkle-blocks")


def _climb(leaves: DataFrame, members: list[str]) -> list[DataFrame]:
    """Rounds of blocks: the tops of one round's blocks are the next one's leaves, until each tree is one block."""
    rounds = [_round(leaves, members)]
    while not (open_ := rounds[-1].filter(F.col("size") > BLOCK)).isEmpty():
        size = F.ceil(F.col("size") / BLOCK).alias("size")
        top = F.element_at("nodes", -1).alias("digest")
        rounds.append(_round(open_.select("tree", F.col("block").alias("pos"), size, top), []))
    return rounds


def _finished(rounds: list[DataFrame]) -> DataFrame:
    """(tree, digest): the one node that is left of each tree."""
    tops = None
    for blocks in rounds:
        own = blocks.filter(F.col("size") <= BLOCK).select("tree", F.element_at("nodes", -1).alias("digest"))
        tops = own if tops is None else tops.unionByName(own)
    return tops


def _level(nodes: bytes, states: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(nodes, np.uint8).reshape(-1, 32), np.frombuffer(states, np.uint8).reshape(-1, FANOUT, 32)


def _paths(name: str | None):
    """Of each block's members: (tree, pos, subroot, path), the path from the member to the root.

    ``name``: the member column with the names of the trees whose subroots the members are.
    """

    def steps(nodes: list[bytes], states: list[bytes], node: int) -> list[dict]:
        out = []
        for level, kept in zip(nodes, states, strict=False):  # a last level without parents has no step
            children, before = _level(level, kept)
            first = node - node % FANOUT
            out.append({
                "slot": node % FANOUT,
                "run": children[first : first + FANOUT].tobytes(),
                "state": before[node // FANOUT, node % FANOUT].tobytes(),
            })
            node //= FANOUT
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):  # a block is 512 members
                block = batch.slice(at, 1).to_pylist()[0]
                n = len(block["nodes"][0]) // 32
                paths = [steps(block["nodes"], block["states"], i) + block["path"] for i in range(n)]
                if name is None:
                    trees, subroots = [block["tree"]] * n, [block["subroot"]] * n
                else:
                    trees, subroots = block[name], [block["nodes"][0][32 * i : 32 * i + 32] for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(trees, pa.string()), pa.array(range(block["block"] * BLOCK, block["block"] * BLOCK + n), pa.int64()),
                        pa.array(subroots, pa.binary()), pa.array(paths, pa.list_(_STEP)),
                    ],
                    names=["tree", "pos", "subroot", "path"],
                )

    return run


_PATH_FIELDS = f"tree string, pos long, subroot binary, path {_PATH}"


def _with_paths(rounds: list[DataFrame], outer: DataFrame | None) -> DataFrame:
    """The first round's blocks with the paths from their tops to the root and their trees' subroots.

    ``outer`` has (tree, subroot, path) of each tree; without it, the rounds are the forest's.
    """
    above = None
    for blocks in reversed(rounds):
        done = blocks.filter(F.col("size") <= BLOCK)
        if outer is None:
            done = done.withColumns({"subroot": F.lit(None).cast("binary"), "path": F.array().cast(_PATH)})
        else:
            done = done.join(outer, "tree")
        if above is not None:
            up = above.withColumnRenamed("pos", "block")
            done = done.unionByName(blocks.filter(F.col("size") > BLOCK).join(up, ["tree", "block"]))
        if blocks is not rounds[0]:
            above = stored(done.mapInArrow(_paths(None), _PATH_FIELDS), "merkle-paths")
    return done


def _resumed(now: np.ndarray, state: np.ndarray, blocks: np.ndarray, at: np.ndarray, right: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Parents' digests: ``state`` resumed with ``now`` and the ``right`` nodes that follow ``at`` in ``blocks``."""
    state = sha.absorb(state, sha.hex_block(now))
    for j in range(1, FANOUT):
        has = np.flatnonzero(right >= j)
        if not len(has):
            break
        state[:, has] = sha.absorb(state[:, has], blocks[:, at[has] + j])
    return sha.finished(state, count)


def _folded(blocks: list[dict], now: np.ndarray, owner: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Root digests recomputed from the members' digests ``now``, all members of the blocks at once."""
    now = now.copy()
    for level in range(LEVELS):  # inside the blocks
        who = [b if level < len(b["states"]) else None for b in blocks]
        _climb_once(now, owner, node // FANOUT**level, [b and _level(b["nodes"][level], b["states"][level]) for b in who])
    for step in range(max((len(b["path"]) for b in blocks), default=0)):  # above them: one step for all members of a block
        own = [b["path"][step] if step < len(b["path"]) else None for b in blocks]
        levels = [s and (np.frombuffer(s["run"], np.uint8).reshape(-1, 32), np.frombuffer(s["state"] * FANOUT, np.uint8).reshape(1, FANOUT, 32)) for s in own]
        slots = np.array([s["slot"] if s else 0 for s in own])
        _climb_once(now, owner, slots[owner], levels)
    return now


def _climb_once(now: np.ndarray, owner: np.ndarray, node: np.ndarray, levels: list) -> None:
    """Replace members' digests by their parents', in the blocks that have the level (nodes, states)."""
    have = np.array([lv is not None for lv in levels])
    rows = np.flatnonzero(have[owner])
    if not len(rows):
        return
    sizes = np.array([len(lv[0]) if lv is not None else 0 for lv in levels])
    ups = np.array([len(lv[1]) if lv is not None else 0 for lv in levels])
    nodes = np.concatenate([lv[0] for lv in levels if lv is not None])
    states = np.concatenate([lv[1] for lv in levels if lv is not None])
    mine, place = owner[rows], node[rows]
    first, up = np.cumsum(sizes) - sizes, np.cumsum(ups) - ups
    count = np.minimum(FANOUT, sizes[mine] - place // FANOUT * FANOUT)
    state = sha.states(states[up[mine] + place // FANOUT, place % FANOUT])
    now[rows] = _resumed(now[rows], state, sha.hex_block(nodes), first[mine] + place, count - 1 - place % FANOUT, count)


def _proofs(block: dict) -> list[bytes]:
    """Of each member, the hash of its siblings' hex digests, level by level up to the root."""
    texts = [level.hex().encode() for level in block["nodes"][: len(block["states"])]]
    rest = []
    for step in block["path"]:
        run, slot = step["run"].hex().encode(), step["slot"]
        rest += [run[: 64 * slot], run[64 * slot + 64 :]]
    out = []
    for node in range(len(block["nodes"][0]) // 32):
        parts = []
        for text in texts:
            first = node // FANOUT * FANOUT
            parts += [text[64 * first : 64 * node], text[64 * node + 64 : 64 * (first + FANOUT)]]
            node //= FANOUT
        out.append(hashlib.sha256(b"".join([*parts, *rest])).digest())
    return out


def _prove():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE // BLOCK):
                blocks = batch.slice(at, ROWS_AT_ONCE // BLOCK).select(["nodes", "states", "path", "subroot", "claim"]).to_pylist()
                keys = batch.column("key").slice(at, ROWS_AT_ONCE // BLOCK).flatten()
                yield _proven(blocks, keys)

    def _proven(blocks: list[dict], keys: pa.Array) -> pa.RecordBatch:
        leaves = np.frombuffer(b"".join(b["nodes"][0] for b in blocks), np.uint8).reshape(-1, 32)
        sizes = [len(b["nodes"][0]) // 32 for b in blocks]
        owner, node = np.repeat(np.arange(len(blocks)), sizes), np.concatenate([np.arange(n) for n in sizes])
        now = leaves.copy()
        for i, claim in enumerate(c for b in blocks for c in b["claim"]):
            if claim is not None:
                now[i] = np.frombuffer(claim, np.uint8)
        folded = _folded(blocks, now, owner, node)
        rows = lambda x: pa.array([r.tobytes() for r in x], pa.binary())
        return pa.RecordBatch.from_arrays(
            [
                keys, rows(leaves), pa.array([blocks[b]["subroot"] for b in owner], pa.binary()),
                pa.array([p for b in blocks for p in _proofs(b)], pa.binary()), rows(folded),
            ],
            names=["key", "leaf", "subroot", "proof", "folded"],
        )

    return run


@dataclass
class Manifest:
    """The stored trees of a dataset: rounds of blocks of its leaves, and of its subroots (the forest)."""

    key: str
    rounds: list[DataFrame]
    forest: list[DataFrame]
    root: bytes | None

    def subroots(self) -> DataFrame:
        """(tree, digest) of each group; a tree is named ``=`` and the group's name, the null group ``-``."""
        return _finished(self.rounds)

    def prove(self) -> DataFrame:
        """A row for each leaf: its digests, the hash of its proof, and what its claim folds to (all in hex)."""
        subtrees = _with_paths(self.forest, None).mapInArrow(_paths("name"), _PATH_FIELDS).drop("pos")
        blocks = _with_paths(self.rounds, stored(subtrees, "merkle-paths"))
        kind = blocks.schema["key"].dataType.elementType
        digests = [T.StructField(n, T.BinaryType()) for n in ("leaf", "subroot", "proof", "folded")]
        wanted = blocks.select("nodes", "states", "path", "subroot", "claim", "key")
        proven = wanted.mapInArrow(_prove(), T.StructType([T.StructField("key", kind), *digests]))
        text = lambda c: F.lower(F.hex(c))
        root = F.lit(None if self.root is None else self.root.hex()).cast("string")
        return proven.select(
            F.col("key").alias(self.key),
            text("leaf").alias("leaf"),
            text("subroot").alias("subroot"),
            root.alias("root"),
            text("proof").alias("proof_sha256"),
            text("folded").alias("folded_root"),
            (text("folded") == root).alias("verified"),
        )


def manifest(
    df: DataFrame, columns: list[str], key: str = "doc_id", group: str = "lang", claims: dict[str, Column] | None = None,
    claimed: Column | None = None,
) -> Manifest:
    """The manifest of ``df``, whose leaves are hashes of ``columns``.

    ``claims`` are values of columns to be checked in place of the table's own, where ``claimed`` holds.
    """
    leaf = leaf_hash([F.col(f"`{c}`") for c in columns])
    claim = F.lit(None).cast("binary")
    if claims:
        changed = leaf_hash([claims.get(c, F.col(f"`{c}`")) for c in columns])
        claim = F.when(F.lit(True) if claimed is None else claimed, changed)
    name = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("-"))
    rows = df.select(F.col(f"`{key}`").alias("key"), name.alias("tree"), leaf.alias("digest"), claim.alias("claim"))
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "merkle-leaves")
    placed = in_order(rows, "tree", ["key", "digest", "_row"])
    rounds = _climb(placed, ["key", "claim"])
    subroots = _finished(rounds).select(F.lit(FOREST).alias("tree"), F.col("tree").alias("name"), "digest")
    stood = in_order(subroots, "tree", ["name"])
    forest = _climb(stood, ["name"])
    unstore(rows, placed, stood)
    top = _finished(forest).first()
    return Manifest(key, rounds, forest, None if top is None else bytes(top["digest"]))
