"""Texts and tables that the tests share."""

from __future__ import annotations

FOLDER = "/root/testdata/sf0.001"
WORDS = [a + b for a in ("ba", "ce", "di", "fo", "gu", "ha", "ju", "ki") for b in ("la", "me", "no", "pi", "ru", "sta", "tor", "x")]


def prose(seed: int, n: int) -> str:
    """Words in an order that depends on the seed."""
    out, state = [], seed * 2654435761 % 2**32 + 1
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(WORDS[state >> 16 & 63])
    return " ".join(out)
