"""Embedding links against all pairs, and components against a search."""

from __future__ import annotations

import math

import numpy as np
import pytest

from fairdraw.llm import components as component_table
from fairdraw.llm import vectors
from fairdraw.llm.components import components
from fairdraw.llm.storage import new_folder


@pytest.fixture
def embeddings(spark):
    kind = "vec_id long, embedding array<float>, label int, n int, key string"
    return lambda rows: spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], kind).repartition(3)


def brute(rows):
    usable = {}
    for at, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            table = np.asarray(v, np.float32).astype(float)
            usable[at] = table / np.linalg.norm(table)
    links = {at: set() for at in range(len(rows))}
    for a in usable:
        for b in usable:
            if a != b and len(usable[a]) == len(usable[b]) and usable[a] @ usable[b] >= 0.9:
                links[a].add(b)
    out = []
    for at, (i, _) in enumerate(rows):
        seen, todo = {at}, [at]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        smallest = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((i, len(links[at]), smallest, not links[at] or i == smallest))
    return sorted(out, key=repr)


def found(table):
    return sorted(map(tuple, vectors.near_duplicates(table).collect()), key=repr)


def corpus(size=12, n=400):
    rng = np.random.default_rng(size)
    centers = rng.normal(size=(15, size))
    rows = []
    for i in range(n):
        spread = (0.02, 0.25, 0.45, 1.5)[i % 4]
        v = centers[i % 15] / np.linalg.norm(centers[i % 15]) + spread * rng.normal(size=size) / np.sqrt(size)
        rows.append((i * 2, (v * rng.uniform(0.1, 9)).astype(np.float32).tolist()))
    rows += [(2000 + i, rows[3][1]) for i in range(30)]
    return rows


def test_against_all_pairs(embeddings, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 32)
    monkeypatch.setattr(vectors, "FAN", 3)
    rows = corpus()
    rows += [(3000, None), (3001, []), (3002, [0.0] * 12), (3003, [float("nan")] * 12), (3004, [float("inf")] + [1.0] * 11)]
    rows += [(3005, [None] + [1.0] * 11), (3006, [1.0, 2.0]), (3007, [2.0, 4.0]), (3008, [1e-30] * 12), (3009, [1e30] * 12)]
    assert found(embeddings(rows)) == brute(rows)


def test_null_and_repeated_ids(embeddings):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(5, a), (5, a), (None, a), (7, a), (None, b), (9, None), (9, None)]
    got = found(embeddings(rows))
    assert got == sorted(
        [(5, 3, 5, True), (5, 3, 5, True), (None, 3, 5, False), (7, 3, 5, False), (None, 0, None, True), (9, 0, 9, True), (9, 0, 9, True)],
        key=repr,
    )


def test_empty_table(embeddings):
    assert found(embeddings([])) == []
    assert found(embeddings([(1, None)])) == [(1, 0, 1, True)]


def test_distant_blocks_are_skipped(spark, embeddings, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 32)
    monkeypatch.setattr(vectors, "FAN", 4)
    rng = np.random.default_rng(1)
    rows = [(i, (np.eye(8)[i % 8] + 0.01 * rng.normal(size=8)).tolist()) for i in range(640)]
    nodes = vectors.keyed(embeddings(rows)).selectExpr("key", "1L as n", "embedding")
    folder = new_folder(spark, "test")
    sequenced = vectors._sequenced(nodes, 8, folder).cache()
    pairs = vectors._near_blocks(sequenced, folder).count()
    blocks = sequenced.select("block").distinct().count()
    assert blocks == 20 and pairs < blocks * (blocks + 1) / 2 * 0.5


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 3), (3, 7), (9, 9), (3, 50), (50, 49), (200, None)] + [(1000, i) for i in range(1001, 1100)]
    got = components(spark.createDataFrame(edges, "x long, y long"), new_folder(spark, "test"), "c").collect()
    want = {i: 100 for i in range(101, 161)} | {7: 3, 50: 3, 49: 3} | {i: 1000 for i in range(1001, 1100)}
    assert {r.id: r.component for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "x long, y long"), new_folder(spark, "test"), "c").collect() == []


def test_doubles_are_not_rounded(spark):
    # The cosine of each pair with (1, 0) lies 1e-9 above and below the limit; floats round both to one vector.
    near = [[c, math.sqrt(1 - c * c)] for c in (0.9 + 1e-9, 0.9 - 1e-9)]
    rows = [(1, [1.0, 0.0]), (2, near[0])]
    rows += [(11, [0.0, 0.0, 1.0]), (12, [0.0, near[1][1], near[1][0]])]
    # Beyond the range of floats, and where squares leave that of doubles.
    rows += [(21, [1e200, 0.0, 0.0, 0.0]), (22, [2e200, 1e199, 0.0, 0.0]), (23, [1e-200, 0.0, 0.0, 0.0]), (24, [0.0, 5e-324, 0.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = [(1, 1, 1, True), (2, 1, 1, False), (11, 0, 11, True), (12, 0, 12, True)]
    want += [(21, 2, 21, True), (22, 2, 21, False), (23, 2, 21, False), (24, 0, 24, True)]
    assert found(table) == sorted(want, key=repr)


def test_doubles_equal_as_floats_have_keys_of_their_own(spark):
    table = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0 + 1e-12]), (3, [1.0, 2.0])], "vec_id long, embedding array<double>")
    keys = {r.vec_id: r.key for r in vectors.keyed(table).collect()}
    assert keys[1] == keys[3] != keys[2]


@pytest.mark.parametrize("parts", [1, 30])
def test_components_with_large_vertices(spark, monkeypatch, parts):
    """Stars of different sizes, some joined by a chain, against a search."""
    monkeypatch.setattr(component_table, "PARTS", parts)
    edges = [(5, 1000 + i) for i in range(300)] + [(3000 + i, 2999) for i in range(100)] + [(1000, 3000), (7, 8), (8, 9), (9, 7)]
    edges += [(5000 + i, 5001 + i) for i in range(40)]
    got = components(spark.createDataFrame(edges, "x long, y long").repartition(3), new_folder(spark, "test"), "c").collect()
    near = {}
    for x, y in edges:
        near.setdefault(x, set()).add(y)
        near.setdefault(y, set()).add(x)
    expected, seen = set(), set()
    for start in sorted(near):
        todo = [start] if start not in seen else []
        while todo:
            at = todo.pop()
            if at not in seen:
                seen.add(at)
                expected |= {(at, start)} if at != start else set()
                todo += near[at]
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)


def test_rounds_of_components_take_few_jobs(spark):
    """What the driver remembers of jobs and their tasks adds up over the rounds."""
    edges = [(i, i + 1) for i in range(40)] + [(1000, i) for i in range(1001, 1100)]
    scheduler = spark.sparkContext._jsc.sc().dagScheduler()
    folder, before = new_folder(spark, "test"), scheduler.numTotalJobs()
    got = components(spark.createDataFrame(edges, "x long, y long").repartition(3), folder, "c").collect()
    assert len(got) == 40 + 99 and {r.component for r in got} == {0, 1000}
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    rounds = len(path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)) // 2
    assert (scheduler.numTotalJobs() - before - 8) / rounds <= 14
