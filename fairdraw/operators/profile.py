"""Counts that describe strata, levels and allocations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairdraw.functions.columns import display_key, level, name, text
from fairdraw.plans.quota import Quota, allocate, stratum_sizes

# The stratum sizes that the profile counts.
EXACT_SIZES = (1, 2)
SIZE_LIMITS = (5, 10)


def strata_sizes(df: DataFrame, strata: Sequence[str]) -> DataFrame:
    """The strata with their display key and number of rows."""
    return stratum_sizes(df, strata).select(*strata, display_key(strata).alias("stratum"), "pop_n")


def strata_count(df: DataFrame, strata: Sequence[str]) -> DataFrame:
    """One row: the number of distinct strata."""
    return df.select(*strata).distinct().agg(F.count(F.lit(1)).alias("n_strata"))


def strata_profile(df: DataFrame, strata: Sequence[str]) -> DataFrame:
    """One row: how many strata have one row, two rows, under five and ten."""
    sizes = stratum_sizes(df, strata)
    return sizes.agg(
        F.count(F.lit(1)).alias("n_strata"),
        *[F.expr(f"count_if(pop_n = {n})").alias(f"n_size_{n}") for n in EXACT_SIZES],
        *[F.expr(f"count_if(pop_n < {n})").alias(f"n_under_{n}") for n in SIZE_LIMITS],
    )


def level_counts(df: DataFrame, columns: Sequence[str], value: str = "n") -> DataFrame:
    """``column, level`` and the rows of each level, all columns in one pass. A
    missing level is null here, so that it keeps apart from a level that has
    the name it is reported under."""
    pairs = ", ".join(f"{text(c)}, cast({name(c)} as string)" for c in columns)
    return (
        df.select(F.expr(f"stack({len(columns)}, {pairs}) as (column, level)"))
        .groupBy("column", "level")
        .agg(F.count(F.lit(1)).alias(value))
    )


def with_shares(levels: DataFrame, **shares: str) -> DataFrame:
    """Add shares of each column's totals: ``with_shares(levels, pct="n")``. The
    totals are one row per column, however many levels there are."""
    totals = levels.groupBy("column").agg(*[F.sum(n).alias(f"_fd_{n}") for n in shares.values()])
    return levels.join(F.broadcast(totals), "column").select(
        *levels.columns,
        *[F.expr(f"if(_fd_{n} > 0, {n} / _fd_{n}, 0D)").alias(share) for share, n in shares.items()],
    )


def level_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, level, n, share``, most frequent first."""
    shares = with_shares(level_counts(df, columns), share="n")
    return shares.orderBy("column", F.desc("n"), F.asc_nulls_first("level")).withColumn("level", level("level"))


def sample_rate(population: DataFrame, sample: DataFrame) -> DataFrame:
    """One row: both sizes and the sampled percentage."""
    counts = population.select(F.lit(1).alias("p"), F.lit(0).alias("s")).unionByName(
        sample.select(F.lit(0).alias("p"), F.lit(1).alias("s"))
    )
    return counts.agg(
        F.coalesce(F.sum("p"), F.lit(0)).alias("pop_n"), F.coalesce(F.sum("s"), F.lit(0)).alias("samp_n")
    ).withColumn("samp_pct", F.expr("if(pop_n = 0, 0D, floor(samp_n / pop_n * 100 * 100 + 0.5D) / 100)"))


def allocation_table(df: DataFrame, strata: Sequence[str], quota: Quota) -> DataFrame:
    """Per stratum: rows, rows wanted and taken, floor and cap marks."""
    return allocate(stratum_sizes(df, strata), quota)


def floor_cap_report(df: DataFrame, strata: Sequence[str], quota: Quota) -> DataFrame:
    """One row: strata lifted to the minimum, strata smaller than their target,
    and strata that give nothing without a floor."""
    return allocation_table(df, strata, quota).agg(
        F.count(F.lit(1)).alias("n_strata"),
        F.expr("count_if(is_floored)").alias("n_floored"),
        F.expr("count_if(is_capped)").alias("n_capped"),
        F.expr("count_if(n_raw = 0)").alias("n_vanishing"),
        F.coalesce(F.sum("n_take"), F.lit(0)).cast("bigint").alias("n_take"),
    )


def vanished_strata(df: DataFrame, strata: Sequence[str], pct: float) -> DataFrame:
    """The strata that a purely proportional sample would lose."""
    table = allocation_table(df, strata, Quota(pct=pct))
    return table.where("n_take = 0").select(*strata, "pop_n")
