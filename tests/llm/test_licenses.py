"""License phrases against a scan of every text."""

from __future__ import annotations

import re

from samples import prose

from fairdraw.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(text):
    words, starts, labels = WORD.findall((text or "").translate(LOWER)), [], set()
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def found(table):
    return {r.doc_id: r for r in licenses.scan(table).collect()}


NOTICE = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
TEXTS = [
    None, "", " \n", "MIT License", "the mit  license.\nThe MIT-LICENSE and Apache License; cc by cc by cc by",
    "GNU General Public License gnu general public gnu general public license", "mit", "license mit", "by cc by",
    NOTICE, prose(1, 50) + "\n" + NOTICE.replace("free of", "entirely free of") + " " + prose(2, 10),
    "Released under the MIT License.", "Released under the new MIT License.", "Apache License", "mit license " * 3000, prose(4, 30_000),
]


def test_phrases_are_all_found(documents):
    got = found(documents(list(enumerate(TEXTS))))
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.labels == "") == (r.score == 0)


def test_spans_survive_words_put_in(documents):
    got = found(documents(list(enumerate(TEXTS))))
    assert got[9].labels == "mit-text" and got[9].score == 1
    assert got[10].labels == "mit-text" and 0.8 < got[10].score < 1
    assert got[12].labels == "mit,mit-notice" and got[11].labels == "mit,mit-notice"
    table = documents([(1, prose(3, 20) + " " + NOTICE + " " + prose(4, 20))])
    (span,) = licenses.spans(licenses.votes(table)).collect()
    assert (span.first_word, span.last_word, span.share) == (20, 20 + 15, 1.0)


def test_null_and_repeated_ids(documents):
    got = licenses.scan(documents([(None, "mit license"), (None, "cc by"), (2, "mit license"), (2, "mit license"), (2, None)]))
    rows = sorted(((r.doc_id, r.n_words, r.base_labels) for r in got.select("doc_id", "n_words", "base_labels").collect()), key=repr)
    assert rows == sorted([(2, 2, "mit"), (2, 2, "mit"), (2, 0, ""), (None, 2, "mit"), (None, 2, "cc-by")], key=repr)


def spans_of(text):
    """Spans by a plain walk: chains of diagonals in the order of their places."""
    words, out = WORD.findall((text or "").translate(LOWER)), []
    for template, label in licenses.TEXTS.items():
        parts = template.split()
        pairs = list(zip(parts, parts[1:]))
        diagonals = {}
        for p, pair in enumerate(zip(words, words[1:])):
            for q, other in enumerate(pairs):
                if pair == other:
                    diagonals.setdefault(p - q, set()).add(q)
        chains = []
        for d, at in sorted(diagonals.items(), key=lambda x: (x[0] + min(x[1]), x[0])):
            last = chains[-1][-1] if chains else None
            if last:
                ahead = d + min(at) - last[0] - max(last[1])
                near = abs(d - last[0]) <= licenses.GAP and 0 <= ahead <= licenses.GAP + 1 and min(at) > max(last[1])
            if last and near:
                chains[-1].append((d, at))
            else:
                chains.append([(d, at)])
        for chain in chains:
            at = set().union(*(at for _, at in chain))
            n, inside = len(at), len(at | {q + 1 for q in at})
            first, last = min(d + min(at) for d, at in chain), max(d + max(at) + 1 for d, at in chain)
            if 100 * n >= licenses.SHARE * len(pairs) and 100 * inside >= licenses.SHARE * (last - first + 1):
                out.append((label, first, last, n / len(pairs)))
    return sorted(out)


BODIES = [next(t for t, label in licenses.TEXTS.items() if label == name) for name in ("mit-body", "apache-header", "isc-body")]
SPANS = [
    "the mit license the mit license", "released under the the mit license", "under the mit license released under the",
    "released under released under the mit license mit license", BODIES[0], BODIES[1] + " " + BODIES[2], BODIES[0].replace("software", "program"),
    " ".join(BODIES[2].split()[:40]), " ".join(w for i, w in enumerate(BODIES[0].split()) if i % 25), " ".join(reversed(BODIES[1].split())),
    prose(8, 30) + " " + " x ".join(" ".join(BODIES[0].split()[i : i + 12]) for i in range(0, 170, 12)) + " " + prose(9, 5),
]


def test_spans_and_labels_against_a_walk(documents):
    rows = list(enumerate([*SPANS, *TEXTS[:-1]]))
    table = documents(rows)
    got = {}
    for r in licenses.spans(licenses.votes(table)).where("not exact").collect():
        got.setdefault(r.doc_id, []).append((r.label, r.first_word, r.last_word, r.share))
    assert {i: sorted(x) for i, x in got.items()} == {i: s for i, t in rows if (s := spans_of(t))}
    labels = {i: set(r.labels.split(",")) - {""} for i, r in found(table).items()}
    for i, text in rows:
        assert labels[i] == {s[0] for s in spans_of(text)} | (set(brute(text)[4].split(",")) - {""})
    assert labels[0] == {"mit"} and "mit-body" in labels[4] and labels[9] == set()


def test_templates_are_a_parameter(documents):
    (row,) = licenses.scan(documents([(1, "you may do what you like with this text but keep it whole")]), {"you may do what you like with this text": "own"}).collect()
    assert (row.labels, row.score, row.base_labels) == ("own", 1.0, "")


def test_no_python_on_the_way(spark, documents):
    plan = licenses.votes(documents([(1, "mit license")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(documents):
    assert found(documents([])) == {}
