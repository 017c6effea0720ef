"""The prefix tree against one built from whole sequences."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest

from fairdraw.llm import prefixes

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
KIND = "conv_id long, turn long, role string, text string, node string, shard int, n_convs int"


def expected(rows):
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, role or "", hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest(), text or ""))
    whole = {c: [(r, t) for _, _, r, _, t in sorted(x)] for c, x in turns.items()}
    members = defaultdict(list)
    sequences = {}
    for c in sorted(whole):
        h = zlib.crc32(str(c).encode()) % 6
        first = int(c - (abs(c) % 100) * (1 if c >= 0 else -1))
        sequences[c] = tuple(whole.get(first, [])[:h] + whole[c][h:])
        for d in range(len(sequences[c]) + 1):
            members[sequences[c][:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        below = [sums[c] for c in children[node]]
        sums[node] = (sum(b[0] for b in below) or 1, saved + sum(b[1] for b in below))
    out = []
    for node, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(sequences[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(ids), len(node), parent, len(ids), len(children[node]), *sums[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def check(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], KIND).repartition(5)
    got = prefixes.tree(frame)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected(rows), key=repr)


def conversations(ids, kinds=3):
    """Few different turns, so that prefixes repeat within and across shards."""
    rows = []
    for c in ids:
        for turn in range(c % 7):
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", f"text {(c // (turn + 1)) % kinds} é"))
    return rows


def test_within_and_across_shards(spark):
    check(spark, conversations([*range(0, 120), *range(980, 1110), *range(5000, 5030), 123456]))


def test_one_very_common_conversation(spark):
    check(spark, [(c, t, "user", f"turn {t}") for c in range(0, 2600) for t in range(3)])


def test_nulls_ties_repeated_rows_and_empty_texts(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 1, "user", ""), (1, 1, "user", ""), (1, 1, "assistant", "tie"),
        (2, 3, "user", None), (2, None, None, "x"), (None, 0, "user", "no conversation"), (None, None, None, None),
        (-1, 0, "user", "a"), (-150, 0, "user", "a"), (-150, 1, "user", "b"), (-100, 0, "system", "base"), (-2000, 0, "user", "a"),
        (7, 0, "user", "x" * 100_000), (100, 0, "a", "bc"), (101, 0, "ab", "c"), (199, 9, "u", "late"),
    ]
    check(spark, rows)


def test_long_conversation(spark):
    check(spark, [(c, t, "user", f"{t if t < 150 else (t, c)}") for c in (3, 4, 1004) for t in range(300)])


def test_empty_table(spark):
    assert prefixes.tree(spark.createDataFrame([], KIND)).collect() == []


@pytest.mark.parametrize("size", [1, 64, 999])
def test_nodes_are_intersections(size):
    own = {c: [(bytes([t, c % (t + 2)]), 1) for t in range(c % 5)] for c in range(size)}
    nodes = list(prefixes.Index(own).nodes())
    paths = {tuple(k for k, _ in turns[:d]) for turns in own.values() for d in range(len(turns) + 1)}
    assert len(nodes) == len(paths) and sum(n[5] for n in nodes) == size
    assert [n[0] for n in nodes] == list(range(len(nodes))) and all(n[1] < n[0] for n in nodes)
