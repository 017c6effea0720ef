"""Budgets down the tree, and the documents of each leaf, against plain loops."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
from samples import prose
from pyspark.sql import functions as F

from fairdraw.llm import mixing

DOMAIN = "case when source like 'a%' then 'one' when source like 'b%' then 'two' end"


def share_out(budget, children):
    """``children``: key -> (capacity, weight). Fill those that need least first."""
    order = sorted(children, key=lambda k: (children[k][1] == 0, children[k][0] / children[k][1] if children[k][1] else 0, k))
    left, weight, out = budget, sum(w for _, w in children.values()), {}
    for position, key in enumerate(order):
        capacity, w = children[key]
        if capacity * weight <= w * left:
            out[key], left, weight = capacity, left - capacity, weight - w
            continue
        for other in order[position:]:
            out[other] = children[other][1] * left // weight if children[other][1] else 0
        break
    return out


def brute(rows, mix):
    leaves, weights = defaultdict(int), mix.weights

    def node(value):
        return "" if value is None else "=" + value

    placed = []
    for i, text, lang, source in rows:
        domain = "one" if (source or "").startswith("a") else "two" if (source or "").startswith("b") else None
        leaf, n = (node(domain), node(lang), node(source)), len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        leaves[leaf] += n
        placed.append((i, leaf, n))

    def weight(depth, key):
        return weights.get(mixing.LEVELS[depth], {}).get(key[1:], 1)

    def usable(leaf):
        return all(weight(d, leaf[d]) for d in range(3))

    capacity = {leaf: n * mix.max_epochs if usable(leaf) else 0 for leaf, n in leaves.items()}
    given = {(): min(sum(capacity.values()), sum(leaves.values()) * mix.budget_permille // 1000)}
    for depth in range(3):
        below = {}
        for path, budget in given.items():
            children = defaultdict(int)
            for leaf, c in capacity.items():
                if leaf[:depth] == path:
                    children[leaf[: depth + 1]] += c
            below |= share_out(budget, {k: (c, weight(depth, k[-1])) for k, c in children.items()})
        given = below
    out = {}
    for leaf, n in leaves.items():
        full, rest = divmod(given[leaf], n) if n else (0, 0)

        def order(row, full=full):
            return hashlib.md5(f"{mix.seed}|{full}|{'' if row[0] is None else row[0]}".encode()).hexdigest()

        mine, upto = sorted((r for r in placed if r[1] == leaf), key=order), 0
        for row in mine:
            upto += row[2]
            copies = full + (upto <= rest)
            if copies:
                out[row[0]] = copies
    return out, given


def corpus():
    rows = []
    for i in range(240):
        source = ("a1", "a1", "a1", "a2", "b1", "b2", "c", None)[i % 8]
        lang = ("en", "en", "de", None, "fr")[i % 5]
        text = None if i % 41 == 7 else "" if i % 37 == 5 else prose(i, 5 + i * 7 % 60)
        rows.append((i * 5, text, lang, source))
    return rows


@pytest.fixture
def table(spark):
    kind = "doc_id long, text string, lang string, source string"
    return lambda rows: spark.createDataFrame(rows, kind).withColumns({c: F.lit(1) for c in ("tokens", "budget", "rest", "n", "copies")})


@pytest.mark.parametrize(
    "mix",
    [
        mixing.Mix(DOMAIN, {"domain": {"one": 1, "two": 8}}, 700, 1),
        mixing.Mix(DOMAIN, {"domain": {"one": 1, "two": 8}, "lang": {"de": 9}, "source": {"b2": 5}}, 900, 3, seed=7),
        mixing.Mix(DOMAIN, {"lang": {"en": 0, "fr": 0}}, 2000, 2),
        mixing.Mix(DOMAIN, {}, 0, 1),
    ],
)
def test_against_plain_loops(table, mix):
    rows = corpus()
    got = mixing.mixed(table(rows), mix)
    assert got.columns == ["doc_id", "text", "lang", "source", "tokens", "budget", "rest", "n", "copies"]
    want, given = brute(rows, mix)
    assert {r.doc_id: r.copies for r in got.select("doc_id", "copies").collect()} == want


def test_shortage_goes_to_siblings_first():
    given = share_out(100, {"x": (10, 5), "y": (100, 3), "z": (100, 2)})
    assert given == {"x": 10, "y": 54, "z": 36}
    assert share_out(100, {"x": (10, 1), "y": (20, 1)}) == {"x": 10, "y": 20}


def test_ties_are_taken_together_or_not_at_all(table):
    rows = [(None, "one two three", "en", "a1")] * 4 + [(1, "one two", "en", "a1"), (1, "one two", "en", "a1")]
    for permille in (300, 600, 900):
        got = [r.doc_id for r in mixing.mixed(table(rows), mixing.Mix(DOMAIN, {}, permille, 1)).collect()]
        assert got.count(None) in (0, 4) and got.count(1) in (0, 2)
        assert 3 * got.count(None) + 2 * got.count(1) <= 16 * permille // 1000


def test_empty_table(table):
    assert mixing.mixed(table([]), mixing.Mix(DOMAIN)).collect() == []
