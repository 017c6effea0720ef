"""Hashes of words that differ in regular patterns."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from fairdraw.llm import text


def patterned(n):
    """Two words of n letters that alternate by the parity of the bits of a place."""
    one = "".join("ab"[i.bit_count() % 2] for i in range(n))
    return one, one.translate(str.maketrans("ab", "ba"))


def hashes(*words):
    return text.words_of(text.texts_of(pa.array([" ".join(words)]))).hashes.tolist()


@pytest.mark.parametrize("n", [2, 16, 32, 33, 64, 512, 1024, 4096, 1 << 16])
def test_patterned_words_differ(n):
    one, other = patterned(n)
    found = hashes(one, other, one, one.upper())
    assert found[0] != found[1] and found[0] == found[2] == found[3]


def test_words_beyond_a_slice():
    n = 3 * text.SLICE
    found = hashes("x" * n, "short", "x" * (n - 1) + "y", "x" * n, "short")
    assert found[0] == found[3] != found[2] and found[1] == found[4]


@pytest.mark.parametrize("same", [False, True])
def test_pieces_are_numbered_by_their_bytes(monkeypatch, same):
    """Also where all hashes are equal."""
    if same:
        monkeypatch.setattr(text, "_hashes", lambda data, start, end: np.zeros(len(start), np.uint64))
    monkeypatch.setattr(text, "SLICE", 16)
    words = ["a", "bb", "a", "ccc", "bb", "x" * 50, "x" * 49 + "y", "x" * 50, "ab", "ba"]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    end = np.cumsum([len(w) for w in words])
    which, place = text.numbered(data, end - [len(w) for w in words], end)
    assert [words[i] for i in place[which]] == words and len(place) == len(set(words))


def test_memory_of_hashing_is_bounded():
    """Of what is kept, and of what numbering 2 MB of pieces takes at its peak."""
    assert sum(x.nbytes for x in text._powers()) < 3 << 20
    data = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz01234 " * (1 << 16), np.uint8)
    start = np.arange(0, len(data), 32)
    tracemalloc.start()
    try:
        text.numbered(data, start, start + 31)
        assert tracemalloc.get_traced_memory()[1] < 16 << 20
    finally:
        tracemalloc.stop()
