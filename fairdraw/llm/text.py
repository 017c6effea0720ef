"""Words and shingles of many texts at once, as 64-bit hashes in numpy arrays.

A text column arrives as one buffer of UTF-8 bytes. Words are found by marking
separator bytes; the hashes of all but long ones come from running sums, so no
Python string is made per word. Buffers are worked through in slices cut at separators, which
bounds the working memory whatever the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Bytes hashed or compared at a time: a worker keeps 16 bytes for each of them and
# takes several times that while it works.
SLICE = 1 << 17
# Bytes beyond which words are hashed one by one.
LONG = 32
# Texts of one step; a longer text makes a step of its own.
STEP = 4 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
# ASCII but letters and digits: what parts words that are letters and digits only.
_byte = np.arange(256)
MARKS = (_byte < 128) & ~((_byte >= 48) & (_byte <= 57)) & ~((_byte >= 65) & (_byte <= 90)) & ~((_byte >= 97) & (_byte <= 122))

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    def series(base: int) -> np.ndarray:
        out = np.full(SLICE + 1, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    letters = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    return series(_BASE), series(_INVERSE), letters


@dataclass
class Texts:
    """Texts in one buffer; text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Words of some texts. Word ``j`` of text ``i`` is at ``first[i] + j``;
    ``start`` and ``end`` are its places in the texts' buffer."""

    hashes: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray


def texts_of(column: pa.Array) -> Texts:
    """The texts of a column, null as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.empty(0, np.uint8)
    return Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def steps(texts: Texts, size: int = STEP) -> Iterator[tuple[int, Texts]]:
    """The texts in runs of about ``size`` bytes, with the number of the first."""
    at, n = 0, len(texts)
    while at < n:
        to = max(at + 1, int(np.searchsorted(texts.offsets, texts.offsets[at] + size, "right")) - 1)
        low, high = texts.offsets[at], texts.offsets[to]
        yield at, Texts(texts.data[low:high], texts.offsets[at : to + 1] - low)
        at = to


def bounds_of(
    texts: Texts, separators: np.ndarray = BLANK, cuts: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words between separator bytes start and end, and the number of each
    text's first. ``cuts`` may mark bytes at which a further word starts."""
    data, n = texts.data, len(texts.data)
    begins = np.zeros(n + 1, bool)
    begins[texts.offsets] = True
    if cuts is not None:
        begins[:-1] |= cuts
    inside = ~separators[data]
    before = np.empty(n, bool)
    before[:1], before[1:] = False, inside[:-1]
    start = np.flatnonzero(inside & (begins[:-1] | ~before))
    last = np.ones(n, bool)
    if n:
        last[:-1] = ~inside[1:] | begins[1:-1]
    end = np.flatnonzero(inside & last) + 1
    return start, end, np.searchsorted(start, texts.offsets)


def words_of(
    texts: Texts, separators: np.ndarray = BLANK, fold: np.ndarray = LOWER, cuts: np.ndarray | None = None
) -> Words:
    """Words between separator bytes, hashed after ``fold``."""
    start, end, first = bounds_of(texts, separators, cuts)
    return Words(_hashes(fold[texts.data], start, end), first, start, end)


def heads_of(texts: Texts, words: Words, size: int, fold: np.ndarray = LOWER) -> np.ndarray:
    """Hashes of the words' first ``size`` bytes."""
    return _hashes(fold[texts.data], words.start, np.minimum(words.end, words.start + size))


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of words. Sums of letters times powers tell short words apart; in
    long ones regular patterns can cancel, so these are hashed one by one."""
    powers, inverses, letters = _powers()
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        low = start[at]
        to = max(at + 1, int(np.searchsorted(end, low + SLICE, "right")))
        # A word longer than a slice is a long one: no sums are needed.
        if to > at + 1 or end[at] - low <= SLICE:
            high = end[to - 1]
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(letters[data[low:high]] * powers[: high - low], out=sums[1:])
            s, e = start[at:to] - low, end[at:to] - low
            out[at:to] = mix((sums[e] - sums[s]) * inverses[s] + (e - s).astype(np.uint64))
        at = to
    long = np.flatnonzero(end - start > LONG)
    if len(long):
        out[long] = [xxhash.xxh3_64_intdigest(data[s:e]) for s, e in zip(start[long].tolist(), end[long].tolist(), strict=True)]
    return out


def hashes_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of pieces of ``data`` as they are."""
    return _hashes(data, start, end)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the first of each distinct key stands, in order of the keys, and the
    number of every key among them."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    begins = np.flatnonzero(new)
    return np.minimum.reduceat(order, begins) if len(begins) else order, which


def numbered(
    data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The number of each piece of ``data`` among the distinct ones, and where the
    first of each distinct one stands among the pieces. Pieces are sorted by hashes
    and then compared byte by byte with the first of their number; should any
    differ, all are told apart by their bytes."""
    place, which = _distinct(_hashes(data, start, end) if hashes is None else hashes)
    size, first = end - start, place[which]
    if (size == size[first]).all() and _equal(data, start, start[first], size):
        return which, place
    whole, number = data.tobytes(), {}
    which = [number.setdefault(whole[s:e], len(number)) for s, e in zip(start.tolist(), end.tolist(), strict=True)]
    return np.array(which, np.int64), np.unique(which, return_index=True)[1]


def _equal(data: np.ndarray, one: np.ndarray, other: np.ndarray, size: np.ndarray) -> bool:
    """Whether pieces of given places and sizes are equal, some at a time."""
    upto = np.concatenate(([0], np.cumsum(size)))
    low = 0
    while low < len(size):
        high = max(low + 1, int(np.searchsorted(upto, upto[low] + SLICE, "right")) - 1)
        within = np.arange(upto[high] - upto[low]) - np.repeat(upto[low:high] - upto[low], size[low:high])
        a, b = np.repeat(one[low:high], size[low:high]), np.repeat(other[low:high], size[low:high])
        if (data[a + within] != data[b + within]).any():
            return False
        low = high
    return True


_PAD = np.uint64(0x5851F42D4C957F2D)


def shingles_of(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words, and where each text's run begins. A
    text with fewer words has one shingle, its whole sequence; without words none."""
    n_words = np.diff(words.first)
    counts = np.where(n_words == 0, 0, np.maximum(n_words - k + 1, 1))
    first = np.concatenate(([0], np.cumsum(counts)))
    owner = np.repeat(np.arange(len(n_words)), counts)
    at = words.first[owner] + np.arange(first[-1]) - first[owner]
    end = words.first[owner + 1]
    total = np.zeros(len(at), np.uint64)
    padded = np.concatenate((words.hashes, np.full(k, _PAD)))
    for j in range(k):
        word = padded[at + j]
        if j:
            word = np.where(at + j < end, word, _PAD)
        total = mix(total + word * np.uint64(2 * j + 3))
    return total, first


def rows(batch: pa.RecordBatch, column: str, size: int = STEP) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """A batch in steps of bounded text: its rows, and the texts of the column."""
    for at, texts in steps(texts_of(batch.column(column)), size):
        yield batch.slice(at, len(texts)), texts
