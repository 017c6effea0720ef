"""How far a sample's distributions lie from the population's."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairdraw.functions.columns import (
    THREE_TIER,
    TWO_TIER,
    level,
    name,
    report_round,
    status,
    text,
)
from fairdraw.operators.profile import level_counts, with_shares


def _weighted_counts(df: DataFrame, columns: Sequence[str], weight: str, value: str) -> DataFrame:
    pairs = ", ".join(f"{text(c)}, cast({name(c)} as string)" for c in columns)
    return (
        df.select(F.expr(f"stack({len(columns)}, {pairs}) as (column, level)"), F.col(weight).cast("double").alias("w"))
        .groupBy("column", "level")
        .agg(F.sum("w").alias(value))
    )


def compare_levels(
    population: DataFrame, sample: DataFrame, columns: Sequence[str], *, weight: str | None = None
) -> DataFrame:
    """``column, level, pop_n, samp_n, pop_pct, samp_pct, abs_diff``, all shares
    as fractions. A level that one side lacks counts 0 there.

    Each table is read once for all columns. The counts are added up instead
    of joined. ``weight`` names a column of the sample whose sums replace its
    counts, such as a design weight.
    """
    pop = level_counts(population, columns, "pop_n")
    if weight is None:
        samp = level_counts(sample, columns, "samp_n")
    else:
        samp = _weighted_counts(sample, columns, weight, "samp_n")
    zero = F.lit(0).cast(samp.schema["samp_n"].dataType)
    together = pop.withColumn("samp_n", zero).unionByName(samp.withColumn("pop_n", F.lit(0).cast("bigint")))
    levels = together.groupBy("column", "level").agg(F.sum("pop_n").alias("pop_n"), F.sum("samp_n").alias("samp_n"))
    shares = with_shares(levels, pop_pct="pop_n", samp_pct="samp_n")
    return shares.withColumns({"level": level("level"), "abs_diff": F.abs(F.col("pop_pct") - F.col("samp_pct"))})


def compare_flagged(df: DataFrame, sampled: Column, columns: Sequence[str]) -> DataFrame:
    """The same for a population whose sampled rows carry a mark: one read."""
    pairs = ", ".join(f"{text(c)}, cast({name(c)} as string)" for c in columns)
    levels = (
        df.select(sampled.alias("_fd_in"), *columns)
        .select("_fd_in", F.expr(f"stack({len(columns)}, {pairs}) as (column, level)"))
        .groupBy("column", "level")
        .agg(F.count(F.lit(1)).alias("pop_n"), F.count_if("_fd_in").alias("samp_n"))
    )
    shares = with_shares(levels, pop_pct="pop_n", samp_pct="samp_n")
    return shares.withColumns({"level": level("level"), "abs_diff": F.abs(F.col("pop_pct") - F.col("samp_pct"))})


def _tiered(compared: DataFrame, digits: int, tiers: Sequence) -> DataFrame:
    return compared.withColumn("abs_diff_pct", report_round(F.col("abs_diff") * 100, digits)).select(
        "column", "level", "pop_pct", "samp_pct", "abs_diff_pct", status(F.col("abs_diff_pct"), tiers).alias("status")
    )


def drift_raw(population: DataFrame, sample: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, level, pop_pct, samp_pct, abs_diff``, all fractions."""
    compared = compare_levels(population, sample, columns)
    return compared.select("column", "level", "pop_pct", "samp_pct", "abs_diff")


def drift_two_tier(population: DataFrame, sample: DataFrame, columns: Sequence[str], *, weight: str | None = None) -> DataFrame:
    """Difference in percent with two digits; OK under 5, else DRIFT."""
    return _tiered(compare_levels(population, sample, columns, weight=weight), 2, TWO_TIER)


def drift_three_tier(population: DataFrame, sample: DataFrame, columns: Sequence[str], *, weight: str | None = None) -> DataFrame:
    """Difference in percent with three digits; OK under 2, WATCH under 5, else
    DRIFT."""
    return _tiered(compare_levels(population, sample, columns, weight=weight), 3, THREE_TIER)


def drift_summary(
    report: DataFrame, max_drift_pct: float = 5.0, drifted_from: float = 5.0, *, allocation: DataFrame | None = None
) -> DataFrame:
    """One row over a report in percent: largest and mean difference, levels
    that drifted, and PASS if the largest lies under ``max_drift_pct``. With the
    ``allocation`` table of the sample, also how many strata were lifted to the
    minimum and how many were smaller than their target."""
    summary = _summary(report, max_drift_pct, drifted_from)
    if allocation is None:
        return summary
    marks = allocation.agg(F.expr("count_if(is_floored) as n_floored"), F.expr("count_if(is_capped) as n_capped"))
    return summary.withColumns({c: marks.select(c).scalar() for c in marks.columns})


def _summary(report: DataFrame, max_drift_pct: float, drifted_from: float) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("n_levels"),
        F.max("abs_diff_pct").alias("max_drift_pct"),
        report_round(F.avg("abs_diff_pct"), 4).alias("mean_drift_pct"),
        F.expr(f"count_if(abs_diff_pct >= {float(drifted_from)!r}D)").alias("n_drifted"),
    ).withColumn("verdict", F.expr(f"if(max_drift_pct < {float(max_drift_pct)!r}D, 'PASS', 'REVIEW')"))


def level_representation(
    population: DataFrame, sample: DataFrame, column: str, levels: Sequence[str] | None = None
) -> DataFrame:
    """``level, pop_n, samp_n, kept_pct`` of the named levels, or of all; 0 for
    a level the population lacks. One aggregate for all levels."""
    if levels is not None:
        named = level(column).isin(list(levels))
        population, sample = population.where(named), sample.where(named)
    pop, samp = (
        level_counts(df, [column], n).withColumn("level", level("level")) for df, n in ((population, "pop_n"), (sample, "samp_n"))
    )
    zero = F.lit(0).cast("bigint")
    together = pop.withColumn("samp_n", zero).unionByName(samp.withColumn("pop_n", zero))
    if levels is not None:
        spark = population.sparkSession
        asked = spark.range(1).select(
            F.lit(column).alias("column"),
            F.explode(F.array(*[F.lit(v) for v in levels])).alias("level"),
            zero.alias("pop_n"),
            zero.alias("samp_n"),
        )
        together = together.unionByName(asked)
    counted = together.groupBy("level").agg(F.sum("pop_n").alias("pop_n"), F.sum("samp_n").alias("samp_n"))
    kept = F.when(F.col("pop_n") > 0, F.col("samp_n") / F.col("pop_n") * 100).otherwise(F.lit(0.0))
    return counted.withColumn("kept_pct", report_round(kept, 2))
