"""Stratified samples of every kind."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairdraw.functions.columns import columns_of_type, name
from fairdraw.functions.priority import hex_position, priority
from fairdraw.operators.numeric import (
    BUCKET_PREFIX,
    TAIL,
    coerce_numbers,
    decile_buckets,
    position_buckets,
    winsorize,
)
from fairdraw.operators.positions import FILE_ROW, with_file_rows
from fairdraw.plans.copies import number_copies
from fairdraw.plans.lookup import BROADCAST_KEYS, keep_matching
from fairdraw.plans.quota import Quota, stratum_sizes
from fairdraw.plans.selection import draw
from fairdraw.sources.scratch import ensure_checkpoint_dir


def proportional_sample(
    df: DataFrame, strata: Sequence[str], pct: float, *, ids: Sequence[str] | None = None, seed: int = 42
) -> DataFrame:
    """A share of each stratum, rounded; strata that round to 0 vanish."""
    return draw(df, strata, Quota(pct=pct), ids=ids, seed=seed)


def floor_sample(
    df: DataFrame,
    strata: Sequence[str],
    pct: float,
    min_rows: int = 1,
    *,
    ids: Sequence[str] | None = None,
    seed: int = 42,
    **plan: object,
) -> DataFrame:
    """A share of each stratum, but at least ``min_rows`` of it."""
    if min_rows < 1:
        raise ValueError("min_rows must be at least 1; use proportional_sample without a floor")
    return draw(df, strata, Quota(pct=pct, min_rows=min_rows), ids=ids, seed=seed, **plan)


def fixed_sample(
    df: DataFrame, strata: Sequence[str], n: int, *, ids: Sequence[str] | None = None, seed: int = 42
) -> DataFrame:
    """``n`` rows of each stratum, or all of a smaller one."""
    return draw(df, strata, Quota(n=n), ids=ids, seed=seed)


def total_sample(
    df: DataFrame,
    strata: Sequence[str],
    total: int,
    *,
    min_rows: int = 0,
    total_digits: int | None = None,
    ids: Sequence[str] | None = None,
    seed: int = 42,
) -> DataFrame:
    """A sample of exactly ``total`` rows, or of all rows if there are fewer,
    spread over the strata in proportion to theirs, with ``min_rows`` of each
    where it has as many; a total below the sum of these is refused. With ``total_digits`` the share is rounded first, and each stratum on its
    own, which gives nothing when it rounds to 0."""
    quota = Quota(total=total, min_rows=min_rows, total_digits=total_digits)
    return draw(df, strata, quota, ids=ids, seed=seed)


def boosted_sample(
    df: DataFrame,
    strata: Sequence[str],
    pct: float,
    *,
    below: int | None = None,
    levels: Mapping[str, Sequence] | None = None,
    min_rows: int = 0,
    ids: Sequence[str] | None = None,
    seed: int = 42,
) -> DataFrame:
    """A share of each stratum, but the whole of strata under ``below`` rows and
    of strata with one of the ``levels``. Adds two weights:

    ``sampling_weight``  how far the stratum is over-represented against
                         ``pct``; divide by it.
    ``design_weight``    rows of the population that a sampled row stands for;
                         multiply by it. Its sum is the population size.
    """
    quota = Quota(pct=pct, min_rows=min_rows, boost_below=below, boost_levels=levels or {})
    drawn = draw(df, strata, quota, ids=ids, seed=seed, keep_sizes=True)
    return add_weights(drawn, pct)


def add_weights(drawn: DataFrame, pct: float) -> DataFrame:
    """Replace ``pop_n`` and ``n_take`` of a draw by the two weights."""
    return drawn.withColumns(
        {
            "sampling_weight": F.expr(f"(n_take / pop_n) / {float(pct)!r}D"),
            "design_weight": F.expr("pop_n / n_take"),
        }
    ).drop("pop_n", "n_take")


def weighted_sample(
    df: DataFrame,
    strata: Sequence[str],
    weight: str | Column,
    *,
    pct: float | None = None,
    n: int | None = None,
    min_rows: int = 0,
    ids: Sequence[str] | None = None,
    seed: int = 42,
    **plan: object,
) -> DataFrame:
    """Draw without replacement with chances in proportion to a weight. A weight
    that is constant in a stratum gives the plain draw. Rows whose weight is zero,
    negative, null or not a number come last: they are drawn, in plain random
    order, only where the others of their stratum don't fill its quota."""
    quota = Quota(pct=pct, n=n, min_rows=min_rows)
    return draw(df, strata, quota, ids=ids, seed=seed, weight=weight, **plan)


def drop_small_strata(
    df: DataFrame, strata: Sequence[str], min_rows: int, *, broadcast_keys: int = BROADCAST_KEYS
) -> DataFrame:
    """Rows of the strata with at least ``min_rows`` rows."""
    kept = stratum_sizes(df, strata).where(F.col("pop_n") >= min_rows)
    return keep_matching(df, kept, strata, "pop_n", broadcast_keys)


def decile_cell_sample(
    df: DataFrame,
    columns: Sequence[str],
    pct: float,
    *,
    min_rows: int = 0,
    clip_at: float | None = TAIL,
    ids: Sequence[str] | None = None,
    seed: int = 42,
) -> DataFrame:
    """Coerce, winsorize and bucket numeric columns, then take a share of each
    cell of buckets. The bucket columns stay in the result."""
    bucketed = decile_buckets(coerce_numbers(df, columns), columns, clip_at=clip_at)
    cells = [BUCKET_PREFIX + c for c in columns]
    return draw(bucketed, cells, Quota(pct=pct, min_rows=min_rows), ids=ids, seed=seed)


def position_sample(
    df: DataFrame,
    order_by: str,
    total: int,
    *,
    ids: Sequence[str] | None = None,
    numeric: Sequence[str] | None = None,
    total_digits: int | None = 4,
    seed: int = 42,
) -> DataFrame:
    """A sample of a given size spread over the row positions under an order,
    with the numeric columns coerced and winsorized as in the population."""
    if numeric is None:
        untouched = {order_by, *(ids or [])}
        numeric = [c for c in columns_of_type(df, "numeric") if c not in untouched]
    bucketed = position_buckets(df, order_by)
    quota = Quota(total=total, total_digits=total_digits)
    drawn = draw(bucketed, ["position_bucket"], quota, ids=ids, seed=seed).drop("position_bucket")
    if not numeric:
        return drawn
    return winsorize(coerce_numbers(drawn, numeric), numeric, population=coerce_numbers(df, numeric))


def native_sample(
    df: DataFrame,
    column: str,
    pct: float,
    *,
    shares: Mapping | None = None,
    ids: Sequence[str] | None = None,
    seed: int = 42,
) -> DataFrame:
    """Take each row by its own priority: one pass without any shuffle, but sizes
    only close to the target. ``shares`` may give levels of the column, null
    included, a share other than ``pct``. Without ids equal rows are numbered."""
    for share in (pct, *(shares or {}).values()):
        if not 0 <= share <= 1:
            raise ValueError("shares must lie between 0 and 1")
    rows = number_copies(df) if ids is None else df
    limit = F.expr(hex_position(f"{float(pct)!r}D"))
    for value, share in (shares or {}).items():
        limit = F.when(F.col(name(column)).eqNullSafe(F.lit(value)), F.expr(hex_position(f"{float(share)!r}D"))).otherwise(limit)
    return rows.where(priority(seed, rows.columns if ids is None else ids) < limit).select(*[F.col(name(c)) for c in df.columns])


def random_order_sample(
    df: DataFrame,
    strata: Sequence[str],
    pct: float,
    min_rows: int = 1,
    *,
    depth: int | None = None,
    root: str | None = None,
    seed: int = 42,
) -> DataFrame:
    """The floor sample in random order of rows that have no ids. A row of parquet
    files is known by its place in them, so nothing is written and any split of
    the scan gives the same sample; ``depth`` says how many last parts of a path
    name a file; with ``root``, the path of the table, rows are numbered through all
    its files, so that one file or many give the same sample. The rows of any other table get Spark's ``rand``, written down
    once so that all passes see the same numbers; that sample changes with the
    partitioning."""
    quota = Quota(pct=pct, min_rows=min_rows)
    try:
        placed, ids = with_file_rows(df, depth, root), FILE_ROW
    except ValueError:
        ensure_checkpoint_dir(df.sparkSession)
        ids = ["_fd_rand", "_fd_row"]
        placed = df.withColumn(ids[0], F.rand(seed)).withColumn(ids[1], F.monotonically_increasing_id()).checkpoint()
    return draw(placed, strata, quota, ids=ids, seed=seed).drop(*ids)
