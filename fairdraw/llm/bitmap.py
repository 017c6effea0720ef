"""Tables of fixed size that keep most rows without a partner out of a join."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 24
# Groups of keys in :func:`without`.
GROUPS = 1 << 20
# Two places per hash, from different bits of it.
_SHIFTS = (8, 32)


def bitmap_of(hashes: DataFrame) -> np.ndarray:
    """The bytes of a bitmap of the ``hash`` column; ``BITS / 64`` rows are
    collected at most. The more hashes, the more others it lets pass."""
    at = [F.expr(f"shiftrightunsigned(hash, {shift}) & {BITS - 1}") for shift in _SHIFTS]
    bits = hashes.select(F.explode(F.array(*at)).alias("at")).select(
        F.expr("cast(at div 64 as int)").alias("word"), F.expr("shiftleft(1L, cast(at % 64 as int))").alias("bit")
    )
    words = np.zeros(BITS // 64, np.int64)
    found = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words[np.asarray(found.column("word"))] = np.asarray(found.column("bits"))
    return words.view(np.uint8)


def may_contain(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    keep = np.ones(len(hashes), bool)
    for shift in _SHIFTS:
        bit = (hashes >> np.uint64(shift)) & np.uint64(BITS - 1)
        keep &= (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return keep


def without(rows: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys, null-safely compared, are not among those gone.

    Most rows belong to a group of keys none of which is gone. They are told by a
    broadcast of at most ``GROUPS`` numbers and stay where they are; only the
    others are joined, by broadcast or shuffle as adaptive execution finds best.
    """
    group = F.pmod(F.xxhash64(*keys), F.lit(GROUPS))
    groups = F.broadcast(gone.select(group.alias("__group")).distinct())
    renamed = gone.select(*[F.col(c).alias(f"__gone_{c}") for c in keys])
    same = F.expr(" and ".join(f"`{c}` <=> `__gone_{c}`" for c in keys))
    grouped = rows.withColumn("__group", group)
    sure = grouped.join(groups, "__group", "left_anti")
    rest = grouped.join(groups, "__group", "left_semi").join(renamed, same, "left_anti")
    return sure.unionByName(rest).drop("__group")
