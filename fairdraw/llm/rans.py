"""Static range asymmetric numeral system over blocks of token ids.

All blocks share one frequency table, scaled to ``1 << SCALE``. A block
interleaves up to ``LANES`` coders: token ``i`` belongs to lane ``i % lanes``,
so numpy encodes and decodes a row of lanes at a time. States are 64-bit and
give out 32-bit words. A block holds all that its decoding needs.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

SCALE = 20
LANES = 1024
_LOW = np.uint64(1 << 31)
_HALF = np.uint64(32)
_MASK = np.uint64(0xFFFFFFFF)


@dataclass
class Model:
    """Scaled frequencies, their running sums, and the id of every slot."""

    frequency: np.ndarray
    below: np.ndarray
    slots: np.ndarray

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> Model:
        return cls.of_frequency(scaled(counts))

    @classmethod
    def of_frequency(cls, frequency: np.ndarray) -> Model:
        frequency = frequency.astype(np.uint64)
        below = np.concatenate(([0], np.cumsum(frequency)[:-1])).astype(np.uint64)
        return cls(frequency, below, np.repeat(np.arange(len(frequency), dtype=np.uint32), frequency.astype(np.int64)))


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies summing to ``1 << SCALE``, at least 1 for ids that occur."""
    total, size = int(counts.sum()), 1 << SCALE
    if not total:
        return np.zeros(len(counts), np.int64)
    if np.count_nonzero(counts) > size:
        raise ValueError("more distinct ids than slots")
    frequency = np.where(counts > 0, np.maximum(counts.astype(float) * size // total, 1), 0).astype(np.int64)
    order = np.argsort(-frequency, kind="stable")
    excess = int(frequency.sum()) - size
    for i in order:
        # Rounding is settled on the most frequent ids, where it costs least.
        if excess == 0:
            break
        change = -excess if excess < 0 else -min(excess, int(frequency[i]) // 2)
        frequency[i] += change
        excess += change
    return frequency


def encode(ids: np.ndarray, model: Model) -> bytes:
    """One block: number of tokens, lanes and words, the states, the words."""
    n = len(ids)
    lanes = int(max(1, min(LANES, n // 64)))
    states = np.full(lanes, _LOW, np.uint64)
    limit, room, words = np.uint64(63 - SCALE), np.uint64(SCALE), []
    for low in range((n - 1) // lanes * lanes, -1, -lanes):
        now = ids[low : low + lanes]
        x = states[: len(now)]
        f = model.frequency[now]
        full = x >= (f << limit)
        words.append((x[full] & _MASK).astype("<u4"))
        x = np.where(full, x >> _HALF, x)
        q = x // f
        states[: len(now)] = (q << room) + (x - q * f) + model.below[now]
    stream = np.concatenate(words[::-1]) if words else np.empty(0, "<u4")
    return struct.pack("<III", n, lanes, len(stream)) + states.astype("<u8").tobytes() + stream.tobytes()


def decode(block: bytes, model: Model) -> np.ndarray:
    n, lanes, size = struct.unpack_from("<III", block)
    states = np.frombuffer(block, "<u8", lanes, 12).astype(np.uint64)
    stream = np.frombuffer(block, "<u4", size, 12 + 8 * lanes)
    out, at = np.empty(n, np.uint32), 0
    room, mask = np.uint64(SCALE), np.uint64((1 << SCALE) - 1)
    for low in range(0, n, lanes):
        x = states[: min(lanes, n - low)]
        slot = x & mask
        now = model.slots[slot]
        out[low : low + len(now)] = now
        x = model.frequency[now] * (x >> room) + slot - model.below[now]
        short = np.flatnonzero(x < _LOW)
        x[short] = (x[short] << _HALF) | stream[at : at + len(short)]
        at += len(short)
        states[: len(now)] = x
    if at != size or (states != _LOW).any():
        raise ValueError("damaged block")
    return out


def checksum(data: bytes) -> int:
    return zlib.crc32(data)
