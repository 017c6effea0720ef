"""Near-duplicates against all pairs of documents."""

from __future__ import annotations

import random

from samples import prose

from fairdraw.llm import minhash


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def found(table):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(table).collect()}


def corpus(seed=1):
    """Groups of copies, chains of edits, one group larger than a chunk."""
    rng, texts = random.Random(seed), []
    for i in range(25):
        words = prose(i, 30 + 5 * i).split()
        texts.append(" ".join(words))
        for _ in range(rng.randrange(5)):
            words[rng.randrange(len(words))] = f"new{rng.random():.5f}"
            texts.append(" ".join(words))
    base = prose(77, 120).split()
    for _ in range(150):
        copy = list(base)
        for at in rng.sample(range(120), rng.randrange(1, 9)):
            copy[at] = f"odd{rng.random():.5f}"
        texts.append(" ".join(copy))
    texts += [texts[0], texts[0].upper(), texts[3], "", None, "  \n", "one two", "one two", "one  TWO", "three", "a b c d e", prose(5, 4000)]
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


def test_against_all_pairs(documents):
    rows = corpus()
    assert found(documents(rows)) == brute(rows)


def test_large_buckets_alone_give_the_same(documents, monkeypatch):
    monkeypatch.setattr(minhash, "COLD", 2)
    monkeypatch.setattr(minhash, "CHUNK", 16)
    rows = corpus(2)
    assert found(documents(rows)) == brute(rows)


def test_one_row_of_each_group_stays(documents):
    rows = corpus()
    table = documents(rows)
    got = minhash.deduplicated(table)
    assert got.columns == table.columns
    assert sorted(r.doc_id for r in got.collect()) == [i for i, (_, _, kept) in sorted(brute(rows).items()) if kept]


def test_null_and_repeated_ids(documents):
    text, other = prose(1, 50), prose(2, 50)
    table = documents([(5, text), (5, text), (None, text), (7, text), (None, other), (None, other), (8, None), (8, None)])
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(table).collect()), key=repr)
    assert got == sorted(
        [(5, 5, True), (5, 5, True), (None, 5, False), (7, 5, False), (None, None, True), (None, None, True), (8, 8, True), (8, 8, True)],
        key=repr,
    )
    assert sorted(((r.doc_id, r.text) for r in minhash.deduplicated(table).collect()), key=repr) == sorted(
        [(5, text), (None, other), (8, None)], key=repr
    )


def test_empty_table(documents):
    assert found(documents([])) == {}
    assert minhash.deduplicated(documents([])).collect() == []


def test_words_of_regular_patterns_are_different_documents(documents):
    one = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    got = minhash.near_duplicates(documents([(1, one), (2, one.translate(str.maketrans("ab", "ba"))), (3, one)]))
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == [(1, 1), (2, 2), (3, 1)]
