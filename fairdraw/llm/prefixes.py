"""Prefix tree of conversations by vertical bitmaps.

Conversations are dealt to shards by ranges of ``SHARD`` ids, so a shard has a
bounded number of them however often a turn repeats. A shard's index maps
(position, turn) to the bitset of the conversations that have this turn there,
and a position to those that end there; bitsets are Python integers. A node is the
bitset of its members. Its members that end are an intersection with one posting;
each child is the intersection with the posting of the lowest member left, which
the child's members then leave. So a shard's tree is walked depth first in as
many intersections as it has nodes.

Shards' nodes of one prefix meet by a 128-bit digest of its turns. Members are
added up and the smallest one is kept. Each node is owned by the shard that has
its smallest member: sums over a subtree run inside the shards, over the nodes
they own, and shards' sums are added up again. No row is ever paired with its
ancestors, so long conversations cost no more than short ones.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairdraw.llm.storage import new_folder, written

#: Ids of a shard, a multiple of the ids that share a beginning.
SHARD, SHARED = 1000, 100
# Rows of a result batch.
ROWS = 10_000
_NODES = "shard long, place long, above long, node binary, depth long, n_convs long, n_ends long, conv_id long, chars long, ends string"
_PARTS = (
    "node binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
)


def turns_of(conversations: DataFrame) -> DataFrame:
    """``shard, conv_id, turn, key, chars``: rows with a digest of role and text."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    # The length parts the two; half a SHA-256 tells turns apart.
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    known = conversations.where("conv_id is not null")
    return known.select(
        F.expr(f"cast(conv_id as bigint) div {SHARD}").alias("shard"),
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.unhex(F.substring(digest, 1, 32)).alias("key"),
        F.length(text).cast("long").alias("chars"),
        F.substring(role, 1, 64).alias("role"),
    )


def in_shards(turns: DataFrame) -> DataFrame:
    """Rows of a shard together, conversations and turns in order. Turns of the
    same number are ordered by role, then digest."""
    order = ["shard", "conv_id", F.asc_nulls_first("turn"), "role", "key"]
    return turns.repartition("shard").sortWithinPartitions(*order).select("shard", "conv_id", "key", "chars")


def _groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, pa.Table]]:
    """Rows of sorted batches by equal values of a column."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.asarray(batch.column(column))
        bounds = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
        for low, high in zip(bounds, bounds[1:], strict=False):
            part = batch.slice(low, high - low)
            if kept and kept[0].column(column)[0] != part.column(column)[0]:
                yield kept[0].column(column)[0].as_py(), pa.Table.from_batches(kept)
                kept = []
            kept.append(part)
    if kept:
        yield kept[0].column(column)[0].as_py(), pa.Table.from_batches(kept)


def shared_turns(conv_id: int) -> int:
    """How many turns a conversation takes from the first one of its hundred."""
    return zlib.crc32(str(conv_id).encode()) % 6


def rebuilt(own: dict[int, list[tuple[bytes, int]]], shared=shared_turns) -> dict[int, list[tuple[bytes, int]]]:
    """The turns of every conversation of a shard after its beginning is replaced
    by that of the conversation its hundred begins with."""
    out = {}
    for conv_id, turns in own.items():
        n = shared(conv_id)
        # Rounds towards zero, as SQL does.
        first = conv_id - (abs(conv_id) % SHARED) * (1 if conv_id >= 0 else -1)
        out[conv_id] = own.get(first, [])[:n] + turns[n:]
    return out


class Index:
    """Postings of a shard: per position the bitset of every turn, and of the
    conversations that end before it. Bit ``i`` is the ``i``-th smallest id."""

    def __init__(self, conversations: dict[int, list[tuple[bytes, int]]]) -> None:
        self.ids = sorted(conversations)
        self.turns = [conversations[i] for i in self.ids]
        self.postings: list[dict[bytes, int]] = []
        self.ending: dict[int, int] = {}
        for bit, turns in enumerate(self.turns):
            self.postings += [{} for _ in range(len(turns) - len(self.postings))]
            for posting, (key, _) in zip(self.postings, turns, strict=False):
                posting[key] = posting.get(key, 0) | 1 << bit
            self.ending[len(turns)] = self.ending.get(len(turns), 0) | 1 << bit

    def members(self, bits: int) -> Iterator[int]:
        while bits:
            low = bits & -bits
            yield self.ids[low.bit_length() - 1]
            bits ^= low

    def nodes(self) -> Iterator[tuple[int, int, bytes, int, int, int, int, int, str | None]]:
        """Depth first: place, that of the node above, digest, depth, members,
        members that end, the smallest, characters of the last text, and the ids
        of those that end."""
        stack = [((1 << len(self.ids)) - 1, -1, hashlib.sha256(b"").digest()[:16], 0, 0)]
        place = 0
        while stack:
            bits, above, node, depth, chars = stack.pop()
            ends = bits & self.ending.get(depth, 0)
            ended = ",".join(map(str, self.members(ends))) if ends else None
            smallest = self.ids[(bits & -bits).bit_length() - 1]
            yield place, above, node, depth, bits.bit_count(), ends.bit_count(), smallest, chars, ended
            rest = bits ^ ends
            while rest:
                key, length = self.turns[(rest & -rest).bit_length() - 1][depth]
                child = rest & self.postings[depth][key]
                stack.append((child, place, hashlib.sha256(node + key).digest()[:16], depth + 1, length))
                rest ^= child
            place += 1


_NODE_SCHEMA = pa.schema(
    [("shard", pa.int64()), ("place", pa.int64()), ("above", pa.int64()), ("node", pa.binary()), ("depth", pa.int64())]
    + [(c, pa.int64()) for c in ("n_convs", "n_ends", "conv_id", "chars")]
    + [("ends", pa.string())]
)


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for shard, table in _groups(batches, "shard"):
        rows = zip(*(table.column(c).to_pylist() for c in ("conv_id", "key", "chars")), strict=True)
        own = {i: [(key, chars) for _, key, chars in turns] for i, turns in groupby(rows, key=lambda r: r[0])}
        made: list[tuple] = []
        for node in Index(rebuilt(own)).nodes():
            made.append((shard, *node))
            if len(made) == ROWS:
                yield _batch(made, _NODE_SCHEMA)
                made = []
        if made:
            yield _batch(made, _NODE_SCHEMA)


def _batch(made: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*made, strict=True), schema, strict=True)], schema=schema)


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the subtrees of every shard's nodes, of the nodes it owns."""
    names = ["place", "above", "depth", "chars", "all_convs", "all_ends", "all_conv_id"]
    for shard, table in _groups(batches, "shard"):
        place, above, depth, chars, n, ends, conv_id = (table.column(c).to_numpy() for c in names)
        # Rounds towards zero.
        owned = np.where(conv_id < 0, -(-conv_id // SHARD), conv_id // SHARD) == shard
        children = np.zeros(len(place), np.int64)
        # A member that doesn't end is a member of a child.
        leaves = (owned & (ends == n)).astype(np.int64)
        saved = np.where(owned, (n - 1) * chars, 0)
        # Places follow one another, and a node comes before those below it.
        inner = above[1:]
        np.add.at(children, inner, owned[1:].astype(np.int64))
        total_leaves, total_saved = leaves.tolist(), saved.tolist()
        for at, up in zip(range(len(place) - 1, 0, -1), above[:0:-1].tolist(), strict=True):
            total_leaves[up] += total_leaves[at]
            total_saved[up] += total_saved[at]
        parent = pa.array(np.where(above < 0, 0, conv_id[np.maximum(above, 0)]), mask=above < 0)
        columns = [
            table.column("node").combine_chunks(), pa.array(conv_id), pa.array(depth), parent, pa.array(n), pa.array(children),
            pa.array(total_leaves, pa.int64()), pa.array(total_saved, pa.int64()),
        ]
        whole = pa.RecordBatch.from_arrays(
            columns, ["node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
        )
        for low in range(0, whole.num_rows, ROWS):
            yield whole.slice(low, ROWS)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node of the pieces of its list, which come in order."""
    node, digest = None, hashlib.sha256()
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for now, piece in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if now != node:
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = now, hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
        if done:
            yield _batch(done, _DIGEST_SCHEMA)
    if node is not None:
        yield _batch([(node, digest.hexdigest())], _DIGEST_SCHEMA)


_DIGEST_SCHEMA = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])


def tree(conversations: DataFrame) -> DataFrame:
    """All nodes of the prefix tree of the rebuilt conversations, a row each:
    ``conv_id`` (the smallest member), ``depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``.

    Turns are ordered by ``turn``, null first, then by role and digest; null roles
    and texts are empty. A row without ``conv_id`` belongs to no conversation and
    is left out; rows that repeat are turns of their own. An empty table has no
    node, not even the root. Other columns are not read. A list of ending ids is
    digested as a stream of the shards' pieces, whatever its length.
    """
    folder = new_folder(conversations.sparkSession, "prefixes")
    nodes = written(in_shards(turns_of(conversations)).mapInArrow(_trees, _NODES), folder, "nodes", rows=ROWS)
    sums = nodes.groupBy("node").agg(
        F.sum("n_convs").alias("all_convs"), F.sum("n_ends").alias("all_ends"), F.min("conv_id").alias("all_conv_id")
    )
    # A prefix has one row per shard at most.
    known = nodes.select("shard", "place", "above", "node", "depth", "chars").join(sums, "node")
    parts = known.repartition("shard").sortWithinPartitions("shard", "place").mapInArrow(_subtrees, _PARTS)
    whole = parts.groupBy("node").agg(
        *[F.max(c).alias(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs")],
        *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")],
    )
    ended = nodes.where("ends is not null").select("node", "shard", "ends")
    digests = ended.repartition("node").sortWithinPartitions("node", "shard").drop("shard").mapInArrow(_digests, "node binary, ends_sha256 string")
    nothing = hashlib.sha256(b"").hexdigest()
    return whole.join(digests, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
