"""Small strata merged up the hierarchy, against a plain walk."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from fairdraw.operators import collapse


def expected(rows, least):
    """The merged stratum of every row of stratum columns."""
    k, out = len(rows[0]), {}
    level = Counter(rows)
    small = [s for s, n in level.items() if n < least]
    for depth in range(k, -1, -1):
        sums = Counter()
        for s in small:
            if s not in out:
                sums[s[:depth]] += level[s]
        for s in small:
            if s not in out and (sums[s[:depth]] >= least or depth == 0):
                out[s] = s[:depth] + ("Other",) * (k - depth)
    return [out.get(r, tuple(None if x is None else str(x) for x in r)) for r in rows]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("keys", [20_000, 2])
def test_against_a_walk(spark, seed, keys):
    rng = random.Random(seed)
    rows = [(rng.choice("ab"), rng.choice(["x", None, "y"]), min(int(rng.expovariate(0.3)), 20)) for _ in range(400)]
    rows += [("c", "x", 1), ("d", None, 2), (None, None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, p string, q string, r int")
    got = collapse.collapse_small_strata(df, ["p", "q", "r"], 7, broadcast_keys=keys)
    assert got.columns == ["id", "p", "q", "r", "p_original", "q_original", "r_original"]
    found = sorted(got.collect())
    assert [tuple(r[1:4]) for r in found] == [tuple(None if x is None else str(x) for x in e) for e in expected(rows, 7)]
    assert [tuple(r[4:]) for r in found] == rows
    sizes = Counter(tuple(r[1:4]) for r in found)
    assert all(n >= 7 for s, n in sizes.items() if s != ("Other",) * 3)


def test_all_small_all_large_and_none(spark):
    df = spark.createDataFrame([(i, i % 5) for i in range(20)], "id int, s int")
    assert {r.s for r in collapse.collapse_small_strata(df, ["s"], 5).collect()} == {"Other"}
    assert {r.s for r in collapse.collapse_small_strata(df, ["s"], 4).collect()} == {"0", "1", "2", "3", "4"}
    assert collapse.collapse_small_strata(df.where("false"), ["s"], 4).collect() == []


def test_clashes_are_refused(spark):
    df = spark.createDataFrame([(1, "Other", 2)], "id int, s string, `S_Original` int")
    with pytest.raises(ValueError, match="rename"):
        collapse.collapse_small_strata(df, ["s"], 2)
    with pytest.raises(ValueError, match="level"):
        collapse.collapse_small_strata(df.select("id", "s"), ["s"], 2)
    dotted = spark.createDataFrame([(1, "x"), (2, "y")], "id int, `a.b` string")
    assert {r["a.b"] for r in collapse.collapse_small_strata(dotted, ["a.b"], 2).collect()} == {"Other"}
