"""Draws by brute force."""

from __future__ import annotations

import hashlib
from collections import defaultdict


def priority(seed, *ids):
    parts = [str(seed), *("__NA__" if i is None else str(i) for i in ids)]
    return hashlib.md5("|".join(parts).encode()).hexdigest()


def expected_draw(rows, strata, ids, take, seed=42):
    """Brute force: sort every stratum by priority and keep the first rows."""
    groups = defaultdict(list)
    for row in rows:
        groups[tuple(row[c] for c in strata)].append(row)
    kept = []
    for members in groups.values():
        members.sort(key=lambda r: (priority(seed, *[r[c] for c in ids]), *[r[c] for c in ids]))
        kept += members[: take(len(members))]
    return sorted((r[ids[0]] for r in kept))


def share(pct, floor=0):
    return lambda n: min(max(floor, round(n * pct)), n)
