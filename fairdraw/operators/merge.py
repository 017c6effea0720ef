"""Merging the rare levels of a column, with reports and an audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairdraw.functions.columns import INTERNAL, name, text
from fairdraw.plans.lookup import BROADCAST_KEYS, KEY, keyed, mark_matching
from fairdraw.plans.quota import stratum_sizes

# Fixed value: the share below which a level counts as rare.
RARE_SHARE = 0.05

_KEPT = INTERNAL + "kept"
_LEVEL, _SIZE = INTERNAL + "level", INTERNAL + "size"


def _check(threshold: float | None, min_count: int | None) -> None:
    if (threshold is None) == (min_count is None):
        raise ValueError("give either threshold or min_count")
    if threshold is not None and not 0 < threshold < 1:
        raise ValueError("threshold must lie between 0 and 1, both excluded")
    if min_count is not None and min_count < 1:
        raise ValueError("min_count must be at least 1")


def _levels(
    df: DataFrame, column: str, other: str, threshold: float | None, min_count: int | None, merge_nulls: bool
) -> DataFrame:
    """The levels as ``_LEVEL`` with ``n, pct, is_rare, label_new``."""
    _check(threshold, min_count)
    counts = df.groupBy(F.col(name(column)).alias(_LEVEL)).agg(F.count(F.lit(1)).alias("n"))
    table = counts.withColumn("pct", F.col("n") / counts.agg(F.sum("n").alias("rows")).scalar())
    rare = F.col("pct") < F.lit(threshold) if min_count is None else F.col("n") < min_count
    if not merge_nulls:
        rare = rare & F.col(_LEVEL).isNotNull()
    return table.withColumn("is_rare", rare).withColumn(
        "label_new", F.when(F.col("is_rare"), F.lit(other)).otherwise(F.col(_LEVEL).cast("string"))
    )


def level_table(
    df: DataFrame,
    column: str,
    other: str,
    *,
    threshold: float | None = RARE_SHARE,
    min_count: int | None = None,
    merge_nulls: bool = False,
) -> DataFrame:
    """``<column>, n, pct, is_rare, label_new``: all levels. A level is rare
    strictly below the limit. Rows without a level count in the total; the
    missing level keeps to itself unless ``merge_nulls`` is set."""
    if column in ("n", "pct", "is_rare", "label_new"):
        raise ValueError(f"rename the column {column}: the table of levels has one of that name")
    return _levels(df, column, other, threshold, min_count, merge_nulls).withColumnRenamed(_LEVEL, column)


def merge_rare_levels(
    df: DataFrame,
    column: str,
    other: str,
    *,
    threshold: float | None = RARE_SHARE,
    min_count: int | None = None,
    merge_nulls: bool = False,
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """Replace rare levels by ``other`` and keep the level each row had as
    ``<column>_original``, which must be a new name. A level that is itself
    called ``other`` keeps its rows; they are told apart by that column.

    The rows are matched with hashes of the levels that stay. By share there are
    at most ``1 / threshold`` of these, so they are broadcast; by count, or by a
    tiny share, only the most frequent are.
    """
    if f"{column}_original" in df.columns:
        raise ValueError(f"rename the column {column}_original first")
    kept = _levels(df, column, other, threshold, min_count, merge_nulls).where("not is_rare").select(_LEVEL, "n")
    kept = kept.select(F.col(_LEVEL).alias(column), F.col("n").alias(_SIZE))
    if min_count is None and 1 / threshold <= broadcast_keys:
        few = keyed(kept, [column]).select(*KEY, F.lit(True).alias(_KEPT))
        marked = keyed(df, [column]).join(F.broadcast(few), KEY, "left").drop(*KEY)
    else:
        marked = mark_matching(df, kept, [column], _SIZE, _KEPT, broadcast_keys)
    original = F.col(name(column))
    return marked.withColumns(
        {
            f"{column}_original": original,
            column: F.when(F.col(_KEPT), original.cast("string")).otherwise(F.lit(other)),
        }
    ).select(*[F.col(name(c)) for c in df.columns], F.col(name(f"{column}_original")))


def merge_report(
    df: DataFrame,
    column: str,
    other: str,
    *,
    threshold: float | None = RARE_SHARE,
    min_count: int | None = None,
    merge_nulls: bool = False,
) -> DataFrame:
    """One row: the limit in rows, how many levels merge and stay, and their
    rows. The levels themselves, any number of them, are those of
    :func:`level_table`."""
    table = _levels(df, column, other, threshold, min_count, merge_nulls)
    limit = f"cast(rint({threshold!r}D * sum(n)) as bigint)" if min_count is None else f"cast({min_count} as bigint)"
    return table.agg(
        F.expr(limit).alias("limit_rows"),
        F.expr("count_if(is_rare)").alias("n_merged"),
        F.expr("count_if(not is_rare)").alias("n_kept"),
        F.expr("coalesce(sum(if(is_rare, n, 0)), 0)").alias("rows_merged"),
        F.expr("coalesce(sum(if(is_rare, 0, n)), 0)").alias("rows_kept"),
    )


def strata_before_after(merged: DataFrame, strata: Sequence[str], column: str) -> DataFrame:
    """One row: the exact number of strata before and after merging a column."""
    original = f"{column}_original"
    both = stratum_sizes(merged, [*strata, original])
    before = both.select(*[original if c == column else c for c in strata]).distinct()
    after = both.select(*strata).distinct()
    counted = before.agg(F.count(F.lit(1)).alias("n_before")).withColumn(
        "n_after", after.agg(F.count(F.lit(1)).alias("n")).scalar()
    )
    return counted.withColumn("n_fewer", F.expr("n_before - n_after"))


def merge_audit(sample: DataFrame, column: str, other: str) -> DataFrame:
    """Sampled rows of the merged group per level they had; rows that had that
    level before are not among them."""
    original = f"{column}_original"
    moved = f"{name(column)} = {text(other)} and not (cast({name(original)} as string) <=> {name(column)})"
    return (
        sample.where(moved)
        .groupBy(F.col(name(original)))
        .agg(F.count(F.lit(1)).alias("n_in_sample"))
        .orderBy(F.desc("n_in_sample"), F.col(name(original)))
    )
