"""The two classifiers on held-out rows, and their parts."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from samples import prose

from fairdraw.llm import quality, toxicity


def held_out(i, modulus):
    return zlib.crc32(str(i).encode()) % modulus


def quality_corpus():
    rows, marks = [], []
    for i in range(240):
        text = prose(i, 40 + i % 50).capitalize() + "."
        bad = i % 4 == 0
        if bad:
            text = (text.upper().replace(" ", "!! "), "spam " * 60, text.replace(" ", " ### "))[i // 4 % 3]
        rows.append((i, text))
        marks.append((i, 0 if bad else 1, 0))
    return rows, marks


def test_quality_of_held_out_rows(documents, labels):
    rows, marks = quality_corpus()
    extra = [(1000, None), (1001, ""), (1002, "word"), (None, "no id at all"), (5, "twice"), (1003, "y " * 60_000)]
    got = quality.score_documents(documents([*rows, *extra]), labels([*marks, (None, 1, 1), (7777, None, None)])).collect()
    assert len(got) == len(rows) + len(extra)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is not None and held_out(r.doc_id, 3) == 1) for r in got)
    known = {i: q for i, q, _ in marks}
    tested = [r for r in got if r.held_out and r.doc_id in known and r.doc_id != 5]
    assert len(tested) > 50 and sum(r.predicted == known[r.doc_id] for r in tested) >= 0.97 * len(tested)


def test_quality_stage_keeps_whole_rows(documents, labels):
    rows, marks = quality_corpus()
    table = documents(rows)
    got = quality.accepted(table, labels(marks))
    assert got.columns == table.columns
    kept, good = {r.doc_id for r in got.collect()}, {i for i, q, _ in marks if q}
    assert len(kept & good) >= 0.98 * len(good) and len(kept - good) <= 0.1 * len(kept)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_without_usable_labels(module, documents, labels):
    for marks in ([], [(i, 1, 0) for i in range(30)]):
        got = module.score_documents(documents([(i, prose(i, 9)) for i in range(5)]), labels(marks)).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert module.score_documents(documents([]), labels([])).collect() == []


def test_labels_of_held_out_rows_are_not_learned(documents, labels):
    rows, marks = quality_corpus()
    flipped = [(i, 1 - q if held_out(i, 3) == 1 else q, 0) for i, q, _ in marks]
    scores = [
        {r.doc_id: r.score for r in quality.score_documents(documents(rows), labels(m)).collect()} for m in (marks, flipped)
    ]
    assert scores[0] == scores[1]


def test_pairs_explain_what_single_measures_cannot():
    rng = np.random.default_rng(1)
    x = rng.random((4000, len(quality.MEASURES))).astype(np.float32)
    y = ((x[:, 2] > 0.5) != (x[:, 5] > 0.5)).astype(int)
    model = quality.fit(x[:3000], y[:3000])
    assert any({i, j} == {2, 5} for i, j, *_ in model.pairs)
    assert ((model.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.9


def test_measures_of_single_texts():
    import pyarrow as pa

    from fairdraw.llm.text import texts_of

    texts = [None, "", "Aa aa bb", "One.\nOne.\nTwo", "1234 !!"]
    table = quality.measure(texts_of(pa.array(texts)))
    at = {m: i for i, m in enumerate(quality.MEASURES)}
    assert (table[0] == table[1]).all() and (table[0] == 0).all()
    assert table[2, at["distinct_words"]] == np.float32(2 / 3) and table[2, at["repeated_word"]] == np.float32(1 / 3)
    assert table[3, at["distinct_lines"]] == np.float32(2 / 3) and table[3, at["ends_in_mark"]] == np.float32(2 / 3)
    assert table[4, at["digits"]] == np.float32(4 / 7) and table[4, at["marks"]] == np.float32(2 / 7)


INSULTS = ["zorgface", "blarghead", "zorgly", "snukk"]


def toxic_corpus():
    rows, marks = [], []
    for i in range(400):
        words = prose(i, 30 + i % 60).split()
        toxic = i % 5 == 0
        for k in range(1 + i % 2 if toxic else 0):
            words.insert((i * 7 + k) % len(words), INSULTS[(i // 5 + k) % 4] + (",", "")[k])
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(toxic)))
    return rows, marks


def test_toxicity_of_held_out_rows(documents, labels):
    rows, marks = toxic_corpus()
    extra = [(1000, None), (1001, ""), (None, "you zorgface"), (1002, prose(1, 20_000) + " snukk"), (5, rows[5][1])]
    got = toxicity.score_documents(documents([*rows, *extra]), labels([*marks, (None, 1, 1), (6666, None, None)])).collect()
    assert len(got) == len(rows) + len(extra)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is not None and held_out(r.doc_id, 5) == 0) for r in got)
    known = {i: t for i, _, t in marks}
    tested = [r for r in got if r.held_out and r.doc_id in known]
    assert len(tested) > 50 and sum(r.predicted == known[r.doc_id] for r in tested) >= 0.97 * len(tested)
    by_id = {r.doc_id: r for r in got}
    assert by_id[None].predicted == 1 and by_id[1000].predicted == by_id[1001].predicted == 0


def test_passages_hold_the_insults(documents, labels):
    rows, marks = toxic_corpus()
    got = toxicity.score_documents(documents(rows), labels(marks)).where("n_passages > 0").collect()
    texts = dict(rows)
    assert len(got) >= 70
    for r in got:
        words = texts[r.doc_id].replace(",", "").split()
        for p in r.passages:
            assert {words[p.first_word], words[p.last_word]} <= set(INSULTS)


def test_rate_follows_the_words_of_the_corpus(documents):
    rows, marks = toxic_corpus()
    insults = " snukk Snukk"
    table = documents([(i, f"{text} {prose(i + 1, 900)}{insults * (i == 1)}") for i, text in rows]).select("doc_id", "text")
    taken = table.sparkSession.createDataFrame([(i, t) for i, _, t in marks], "doc_id long, label int")
    evidence = toxicity.learn(table, taken)
    train = table.join(taken, "doc_id")
    counts, total = toxicity._occurrences(train, evidence)
    others = [r.text.replace(",", "").lower().split() for r in train.where("label = 0").collect()]
    assert total == sum(map(len, others))
    # A word takes one piece of evidence, the best of itself and its beginnings.
    telling = sum(word in INSULTS for words in others for word in words)
    assert telling == counts.sum() == 2
    weights = (counts + 1) / (total + len(counts) + 1)
    mean = (1 - weights.sum()) * np.exp(-toxicity.PENALTY * evidence.rate) + (weights * np.exp(evidence.rate * evidence.scores)).sum()
    assert abs(mean - 1) < 1e-6


def test_insults_in_long_documents_are_passages(documents, labels):
    rows, marks = toxic_corpus()
    long = [(i, f"{prose(i + 7, 1500)} {text} {prose(i + 9, 1500)}") for i, text in rows]
    got = {r.doc_id: r.n_passages for r in toxicity.score_documents(documents(long), labels(marks)).collect()}
    assert all((got[i] > 0) == bool(toxic) for i, _, toxic in marks)


def brute_segments(scores):
    """The best run, then the same on both sides of it."""

    def best(low, high):
        runs = [(sum(scores[a:b]), a - b, -a, a, b) for a in range(low, high) for b in range(a + 1, high + 1)]
        top = max(runs, default=(0,))
        if top[0] <= 0:
            return []
        # Of equal runs the shortest, as no part of it may sum to nothing at an end.
        a, b = min(((b - a, a, b) for s, _, _, a, b in runs if abs(s - top[0]) < 1e-9))[1:]
        return [*best(low, a), (a, b - 1, top[0]), *best(b, high)]

    return best(0, len(scores))


def test_segments_against_all_runs():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 5, 12, 25):
        for _ in range(15):
            scores = np.round(rng.normal(-0.4, 2, n), 6)
            got = toxicity.segments(scores)
            want = brute_segments(scores.tolist())
            assert [g[:2] for g in got] == [w[:2] for w in want]
            assert np.allclose([g[2] for g in got], [w[2] for w in want])
