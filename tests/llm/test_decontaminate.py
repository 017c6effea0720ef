"""Benchmark passages against a comparison of every place with every item."""

from __future__ import annotations

import itertools
import random
import re

import pytest
from samples import prose

from fairdraw.llm import decontaminate as dec

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def brute(docs, items):
    out = set()
    for i, text in docs:
        doc = words(text)
        for item_id, item_text in items:
            item = words(item_text)
            if len(item) < dec.LEAST_WORDS:
                continue
            for offset in range(-len(item), len(doc)):
                same = [0 <= offset + j < len(doc) and doc[offset + j] == w for j, w in enumerate(item)]
                size = min(len(item), dec.WINDOW)
                need = size if len(item) < dec.WINDOW else dec.WINDOW - dec.SUBSTITUTED
                if any(sum(same[at : at + size]) >= need for at in range(len(item) - size + 1)):
                    out.add((i, item_id, offset))
    return out


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame([(*r, 1, 2) for r in rows], "item_id long, text string, n int, key int")


def test_masks_miss_no_window():
    for gone in itertools.combinations(range(dec.WINDOW), dec.SUBSTITUTED):
        places = range(dec.WINDOW - dec.SPAN + 1)
        assert any(not {at + i for i in mask} & set(gone) for mask in dec.MASKS for at in places)
    assert all(mask[0] == 0 and mask[-1] == dec.SPAN - 1 for mask in dec.MASKS)


def test_against_all_places(documents, items):
    rng = random.Random(5)
    bench = [(i, prose(1000 + i, 6 + 3 * i)) for i in range(14)] + [(50, None), (51, ""), (52, "a b"), (53, prose(1003, 15).upper())]
    docs = []
    for i in range(60):
        item = words(rng.choice(bench[:14])[1])
        for at in rng.sample(range(len(item)), min(len(item), rng.randrange(0, 5))):
            item[at] = b"other"
        low = rng.randrange(0, 4)
        body = [*prose(i, rng.randrange(0, 30)).encode().split(), *item[low:], *prose(i + 500, rng.randrange(0, 9)).encode().split()]
        docs.append((i, b", ".join(body).decode()))
    docs += [(100, None), (101, ""), (102, "x"), (103, prose(7, 20_000) + " " + bench[9][1]), (None, bench[8][1])]
    got = dec.contaminated(documents(docs), items(bench)).collect()
    assert {(r.doc_id, r.item_id, r.offset) for r in got} == brute(docs, bench)
    assert all(r.agreeing <= 13 and r.first_word <= r.last_word for r in got)


def test_clean_keeps_all_other_rows(documents, items):
    bench, passage = [(1, prose(1, 30))], prose(1, 30)
    table = documents([(1, "so " + passage), (None, passage), (None, None), (2, ""), (3, prose(3, 60)), (3, prose(3, 60))])
    got = dec.clean(table, items(bench))
    assert got.columns == table.columns
    assert sorted((r.doc_id for r in got.collect()), key=repr) == [2, 3, 3, None]


def test_empty_tables(documents, items):
    assert dec.contaminated(documents([]), items([(1, prose(1, 20))])).collect() == []
    assert dec.contaminated(documents([(1, prose(1, 20))]), items([])).collect() == []
    assert dec.clean(documents([(1, prose(1, 20))]), items([])).count() == 1
