"""Small strata merged with their siblings up the hierarchy of stratum columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairdraw.functions.columns import INTERNAL, name
from fairdraw.plans.lookup import BROADCAST_KEYS, attach, join_on_keys
from fairdraw.plans.quota import stratum_sizes
from fairdraw.sources.scratch import ensure_checkpoint_dir

_DEPTH = INTERNAL + "depth"
_TOGETHER = INTERNAL + "together"


def collapsed_strata(sizes: DataFrame, strata: Sequence[str], min_rows: int) -> DataFrame:
    """The strata under ``min_rows`` rows with the number of stratum columns,
    ``_fd_depth``, that still tell their merged stratum from others.

    From the last column to the first: what is too small under one parent is
    added up, and is a stratum of its own if together it has ``min_rows``;
    otherwise it goes on to the parent's level. What is left at the root stays
    together, however small.
    """
    strata = list(strata)
    small = sizes.where(F.col("pop_n") < min_rows)
    # Sums to add up at the next level, and the prefixes at which a sum suffices.
    pending, settled = small, []
    for depth in range(len(strata) - 1, 0, -1):
        above = strata[:depth]
        sums = pending.groupBy(*[F.col(name(c)) for c in above]).agg(F.sum("pop_n").alias("pop_n"))
        settled.append((depth, sums.where(F.col("pop_n") >= min_rows).drop("pop_n").withColumn(_TOGETHER, F.lit(True))))
        pending = sums.where(F.col("pop_n") < min_rows)
    found = small.withColumn(_DEPTH, F.lit(None).cast("int"))
    for depth, prefixes in settled:
        joined = join_on_keys(found, prefixes, strata[:depth], "left")
        found = joined.withColumn(_DEPTH, F.expr(f"if({_DEPTH} is null and {_TOGETHER}, {depth}, {_DEPTH})")).drop(_TOGETHER)
    return found.withColumn(_DEPTH, F.coalesce(F.col(_DEPTH), F.lit(0)))


def collapse_small_strata(
    df: DataFrame,
    strata: Sequence[str],
    min_rows: int,
    label: str = "Other",
    *,
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """All rows, with strata under ``min_rows`` rows merged: the columns in which
    merged strata differ say ``label``, and ``<column>_original`` keeps what they
    said. ``strata`` go from the coarsest column to the finest and become text.

    A merged stratum has ``min_rows`` rows or is what is left of the whole table.
    Nulls are a level. A column that has the label as a level is refused.
    """
    strata = list(strata)
    if min_rows < 1:
        raise ValueError("min_rows must be at least 1")
    taken = {c.lower() for c in df.columns} & {f"{c}_original".lower() for c in strata}
    if taken:
        raise ValueError(f"rename these columns first: {sorted(taken)}")
    ensure_checkpoint_dir(df.sparkSession)
    sizes = stratum_sizes(df, [name(c) for c in strata]).checkpoint()
    clash = [F.coalesce(F.col(name(c)).cast("string") == label, F.lit(False)) for c in strata]
    if not sizes.where(F.greatest(*clash) if len(clash) > 1 else clash[0]).isEmpty():
        raise ValueError(f"a stratum column already has the level {label!r}")
    depths = collapsed_strata(sizes, strata, min_rows).checkpoint()
    marked = attach(df, depths, strata, [_DEPTH], sizes, "pop_n", broadcast_keys)
    values = {
        c: F.when(F.coalesce(F.col(_DEPTH) <= i, F.lit(False)), F.lit(label)).otherwise(F.col(name(c)).cast("string"))
        for i, c in enumerate(strata)
    }
    kept = [values[c].alias(c) if c in values else F.col(name(c)) for c in df.columns]
    return marked.select(*kept, *[F.col(name(c)).alias(f"{c}_original") for c in strata])
