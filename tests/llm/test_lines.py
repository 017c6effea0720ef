"""Line dedup against all pairs of lines."""

from __future__ import annotations

import random

import pytest
from samples import prose

from fairdraw.llm import lines


def brute(rows):
    """Rows are (doc_id, text) with distinct ids, in their order."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first = {}
    for i, text in rows:
        for number, line in enumerate((text or "").split("\n")):
            if line.strip():
                first.setdefault(line, (i is None, i or 0, number))
    near = {a for a in first for b in first if first[b] < first[a] and min(len(a), len(b)) >= 8 and distance_one(a, b)}
    out = {}
    for i, text in rows:
        all_lines = text.split("\n") if text else []
        kept = [
            line for number, line in enumerate(all_lines)
            if not line.strip() or (first[line] == (i is None, i or 0, number) and line not in near)
        ]
        out[i] = (None if text is None else "\n".join(kept), len(all_lines), len(kept))
    return out


def distance_one(a, b):
    """What is left between the common beginning and the common end."""
    while a and b and a[0] == b[0]:
        n = next((n for n in (1000, 100, 10) if a[:n] == b[:n]), 1)
        a, b = a[n:], b[n:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    return max(len(a), len(b)) <= 1


def found(table):
    return {r.doc_id: (r.text, r.n_lines, r.n_kept) for r in lines.deduplicated(table).collect()}


def edited(line, rng):
    at, how = rng.randrange(len(line)), rng.randrange(3)
    return line[:at] + ("", "é", "z" + line[at])[how] + line[at + 1 :]


def test_against_all_pairs(documents):
    rng = random.Random(3)
    pool = [prose(i, 2 + i % 9) for i in range(25)] + ["short", "shore", "", "  ", "é" * 8, "é" * 9, "aaaaaaaa", "aaaaaaab", "aaaaaaaaa"]
    rows = []
    for i in range(60):
        chosen = [rng.choice(pool) for _ in range(rng.randrange(1, 8))]
        chosen = [edited(line, rng) if len(line) > 8 and rng.random() < 0.4 else line for line in chosen]
        rows.append((i, "\n".join(chosen)))
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, rows[0][1]), (103, "x" * 20_000), (104, "x" * 20_001)]
    table = documents(rows)
    assert found(table) == brute(rows)
    assert lines.deduplicated(table).columns == [*table.columns, "n_lines", "n_kept"]


def test_chain_of_edits_compares_with_all_earlier_lines(documents):
    rows = [(0, "the first line"), (1, "the first linex"), (2, "the first linexy"), (3, "the first linexyz")]
    assert [r[2] for _, r in sorted(found(documents(rows)).items())] == [1, 0, 0, 0]


def test_lines_from_the_shortest_on_repeat_shorter_ones(documents):
    rng = random.Random(4)
    pool = ["".join(rng.choice("ab") for _ in range(6 + i % 4)) for i in range(60)]
    rows, earlier = list(enumerate(pool)), []
    for i, line in rows:
        near = line in earlier or len(line) >= 8 and any(distance_one(line, other) for other in earlier)
        earlier.append(line)
        rows[i] = (i, line, int(not near))
    assert any(len(line) == 8 and not kept and not any(len(o) > 7 and distance_one(line, o) for o in pool[:i]) for i, line, kept in rows)
    assert {i: r[2] for i, r in found(documents([r[:2] for r in rows])).items()} == {i: kept for i, _, kept in rows}
    apart = found(documents([(1, "abcdefg"), (2, "abcdefgh"), (3, "ijklmnop"), (4, "ijklmno"), (5, "qrstuvw"), (6, "qrstuvx")]))
    assert [r[2] for _, r in sorted(apart.items())] == [1, 0, 1, 1, 1, 1]


def test_repeated_rows_keep_the_same_lines(documents):
    got = lines.deduplicated(documents([(1, "one line here\nanother line"), (1, "one line here\nanother line")])).collect()
    assert [(r.n_lines, r.n_kept) for r in got] == [(2, 2), (2, 2)]


def test_empty_table(documents):
    assert found(documents([])) == {}


@pytest.mark.parametrize("line", ["a", "ab", "aab", "héé", "x" * 50, "ab" * 30])
def test_variants_are_those_of_the_shorter_lines(line):
    keys = lines.variants_of(line)
    assert len(keys) == len(line) + 1
    for i in range(len(line)):
        shorter = line[:i] + line[i + 1 :]
        assert not shorter or lines.variants_of(shorter)[0] == keys[i + 1]
