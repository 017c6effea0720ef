"""Matching rows with a per-key table when keys are skewed and the number of
keys is not known beforehand.

The most frequent keys, a fixed number of them, are broadcast: no hot key is
shuffled. Keys travel as two 64-bit hashes, so that side has a bound in bytes
whatever the keys hold. The keys beyond that number are each a small part of
the rows, so an ordinary shuffled join holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairdraw.functions.columns import INTERNAL, name, text

# Most rows of a broadcast lookup table.
BROADCAST_KEYS = 20_000

KEY = [INTERNAL + "k1", INTERNAL + "k2"]
GROUP = INTERNAL + "group"
# Groups of keys, for broadcast tables that have something for every key.
GROUPS = 65_536


def hash_of(columns: Sequence[str], salt: str) -> Column:
    """A 64-bit hash of some columns that tells nulls from values and places."""
    parts = [f"{name(c)} is null, {name(c)}" for c in columns]
    return F.expr(f"xxhash64({', '.join([text(salt), *parts])})")


def keyed(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows with the two hashes that stand for a key."""
    return rows.withColumns({KEY[0]: hash_of(columns, "a"), KEY[1]: hash_of(columns, "b")})


def group_of() -> Column:
    return F.expr(f"pmod({KEY[0]}, {GROUPS})")


def join_on_keys(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    small: bool = False,
) -> DataFrame:
    """Null-safe equi-join; the table's key columns are dropped afterwards.
    ``small`` asks for a broadcast: only for tables whose row count has a bound."""
    renamed = {c: f"{INTERNAL}key_{i}" for i, c in enumerate(keys)}
    right = table.withColumnsRenamed(renamed)
    condition = F.expr(" and ".join(f"{name(old)} <=> {new}" for old, new in renamed.items()))
    joined = rows.join(F.broadcast(right) if small else right, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*renamed.values())


def most_frequent(table: DataFrame, size: str, limit: int) -> tuple[DataFrame, DataFrame]:
    """A table with keys as hashes, parted into its ``limit`` largest keys, to be
    broadcast, and the others."""
    head = table.orderBy(F.desc(size), *KEY).limit(limit)
    return head, table.join(F.broadcast(head.select(*KEY)), KEY, "left_anti")


def in_groups_of(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The rows whose group of keys the table has. With an empty table adaptive
    execution drops the branch before it scans anything."""
    groups = table.select(group_of().alias(GROUP)).distinct()
    return rows.withColumn(GROUP, group_of()).join(F.broadcast(groups), GROUP, "left_semi").drop(GROUP)


def keep_matching(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    size: str,
    limit: int = BROADCAST_KEYS,
) -> DataFrame:
    """Rows whose key is in the table. ``size`` names the table's column with
    the number of rows of each key."""
    head, tail = most_frequent(keyed(table, keys).select(*KEY, size), size, limit)
    marked = keyed(rows, keys)
    near = marked.join(F.broadcast(head.select(*KEY)), KEY, "left_semi")
    far = in_groups_of(marked, tail).join(tail.select(*KEY), KEY, "left_semi")
    return near.unionByName(far).select(*rows.columns)


def mark_matching(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    size: str,
    mark: str,
    limit: int = BROADCAST_KEYS,
) -> DataFrame:
    """All rows, with a boolean column telling whether the key is in the table.
    Keys outside the table must be less frequent than those in it."""
    head, tail = most_frequent(keyed(table, keys).select(*KEY, size), size, limit)
    marked, keys_of_head = keyed(rows, keys), F.broadcast(head.select(*KEY))
    near = marked.join(keys_of_head, KEY, "left_semi").withColumn(mark, F.lit(True))
    rest = marked.join(keys_of_head, KEY, "left_anti")
    far = rest.join(tail.select(*KEY, F.lit(True).alias(mark)), KEY, "left")
    return near.unionByName(far.withColumn(mark, F.coalesce(F.col(mark), F.lit(False)))).select(*rows.columns, mark)


def attach(
    rows: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    sizes: DataFrame,
    size: str,
    limit: int = BROADCAST_KEYS,
) -> DataFrame:
    """All rows with the ``values`` the table has for their key, else null.
    ``sizes`` has the number of rows of every key, in the table or not, by which
    the most frequent ones are kept out of a shuffle."""
    marked, values = keyed(rows, keys), list(values)
    known = keyed(table, keys).select(*KEY, *values)
    columns = [*[F.col(name(c)) for c in rows.columns], *values]
    if sizes.count() <= limit:
        return marked.join(F.broadcast(known), KEY, "left").select(*columns)
    head, _ = most_frequent(keyed(sizes, keys).select(*KEY, size), size, limit)
    head = head.join(known, KEY, "left").select(*KEY, *values).checkpoint()
    near = marked.join(F.broadcast(head), KEY).select(*columns)
    rest = marked.join(F.broadcast(head.select(*KEY)), KEY, "left_anti")
    return near.unionByName(rest.join(known, KEY, "left").select(*columns))
