"""Exact order statistics of large columns without sorting them.

Passes over the narrow columns. The first makes an approximate quantile sketch
per group, which brackets every wanted rank. While a bracket may hold more
than ``FEW`` rows, a further pass counts the rows of each bracket exactly and sketches
inside it, for a bracket about a hundred times narrower. The last pass counts the
distinct values inside the brackets and reads the wanted value off the running
count: a task gets ``FEW`` values at most, whatever the size of the table. Each
shuffle carries sketches, counts, or these values; copies of one value travel as
one count, so a value that fills a third of the table costs no more.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairdraw.functions.columns import text
from fairdraw.plans.lookup import join_on_keys
from fairdraw.sources.scratch import ensure_checkpoint_dir

GRID = 500
ACCURACY = 5_000
# Up to this many rows a bracket is not narrowed further.
SMALL = 20 * GRID
# Rows of a bracket whose distinct values one task may count up.
FEW = 1_000_000


def number_list(numbers: Sequence[float]) -> str:
    """SQL text of a constant array of doubles. A single literal in the plan,
    however long."""
    return f"cast(split('{','.join(map(repr, numbers))}', ',') as array<double>)"


def _grid(value: str) -> Column:
    steps = number_list([i / GRID for i in range(GRID + 1)])
    return F.expr(f"percentile_approx({value}, {steps}, {ACCURACY})")


def _low(rank: str, count: str, lowest: str) -> str:
    """SQL text of a value strictly below the one at a rank, so that ties stay
    inside the bracket."""
    step = f"greatest(cast(floor({rank} * {GRID}.0D / {count}) as int) - 1, 0)"
    return f"""if({count} <= {SMALL}, {lowest},
                  coalesce(array_max(filter(grid, v -> v < get(grid, {step}))), {lowest}))"""


def _high(rank: str, count: str, highest: str) -> str:
    """SQL text of a value not below the one at a rank."""
    step = f"cast(floor({rank} * {GRID}.0D / {count}) as int) + 3"
    # The sketch rounds to doubles: only the next one is sure to lie above.
    above = f"array_min(filter(grid, v -> v > get(grid, {step})))"
    return f"if({count} <= {SMALL} or {step} >= {GRID}, {highest}, coalesce({above}, {highest}))"


def _fences(brackets: str) -> Column:
    """The ends of the brackets in order of rank, made non-decreasing. A rank
    whose bracket is overlapped falls into the earlier one."""
    ends = f"flatten(transform({brackets}, b -> array(b.low, b.high)))"
    return F.expr(f"transform({ends}, (v, i) -> array_max(slice({ends}, 1, i + 1)))")


def _cell(first: int, last: int) -> str:
    """SQL text of the number of fences below ``x``, as a binary search: odd
    inside a bracket, even between brackets."""
    if first == last:
        return str(first)
    middle = (first + last) // 2
    return (
        f"case when x > get(fences, {middle}) then {_cell(middle + 1, last)} "
        f"else {_cell(first, middle)} end"
    )


# SQL text of values below and above all others, by the type of ``x``.
DOUBLES = "double('-Infinity')", "double('Infinity')"


def sketch_columns(df: DataFrame, columns: Mapping[str, str], group: str) -> DataFrame:
    """``group, n, grid`` of several columns, given as SQL text by name, in one
    aggregate over the rows as they are."""
    parts = []
    for number, value in enumerate(columns.values()):
        parts += [F.count(F.expr(value)).alias(f"n{number}"), _grid(value).alias(f"grid{number}")]
    label = [f"struct({text(c)} as {group}, n{i} as n, grid{i} as grid)" for i, c in enumerate(columns)]
    return df.agg(*parts).select(F.expr(f"inline(array({', '.join(label)}))")).where("n > 0")


def _narrowed(values: DataFrame, fences: DataFrame, groups: list[str], ranks: str, many: int) -> DataFrame:
    """The fences of narrower brackets. Few rows, or copies of one value, stay
    together."""
    fixed = [*groups, "n"]
    cells = Window.partitionBy(*groups).orderBy("cell")
    counted = (
        join_on_keys(values, fences, groups, small=True)
        .select(*fixed, "x", "fences", F.expr(_cell(0, 2 * many)).alias("cell"))
        .groupBy(
            *fixed,
            "cell",
            F.expr("get(fences, cell - 1)").alias("low_end"),
            F.expr("get(fences, cell)").alias("high_end"),
        )
        .agg(F.count(F.lit(1)).alias("rows"), _grid("if(cell % 2 = 1, x, null)").alias("grid"))
    )
    missed = "raise_error('order statistics: a rank lies outside its bracket')"
    inner_low = f"if(cell % 2 = 1, {_low('place', 'rows', 'low_end')}, {missed})"
    located = (
        counted.withColumn("before", F.sum("rows").over(cells) - F.col("rows"))
        .withColumn("t", F.expr(f"explode({ranks})"))
        .withColumn("place", F.expr("explode(array_distinct(array(t.rank, t.next_rank)))"))
        .where("place > before and place <= before + rows")
        .withColumn("place", F.expr("place - before"))
        .groupBy(*fixed, "t")
        .agg(
            F.min(F.expr(inner_low)).alias("low"),
            F.max(F.expr(_high("place", "rows", "high_end"))).alias("high"),
        )
    )
    return (
        located.groupBy(*fixed)
        .agg(F.expr("array_sort(collect_list(struct(t.rank, t.next_rank, low, high)))").alias("brackets"))
        .select(*fixed, _fences("brackets").alias("fences"))
    )


def order_statistics(
    values: DataFrame,
    groups: Sequence[str],
    ranks: str,
    many: int,
    ends: tuple[str, str] = DOUBLES,
    sketched: DataFrame | None = None,
) -> DataFrame:
    """Values at given ranks in each group of ``values``. Runs jobs.

    ``values`` has the group columns and a column ``x`` without nulls and NaN:
    doubles, or decimals with ``ends`` that no value reaches, which are compared
    exactly whatever their size.
    ``ranks`` is SQL text of an array of ``many`` structs ``(target, rank,
    next_rank)`` in ascending order, over the group columns and ``n``, the
    group's row count; ranks start at 1. The number of groups must have a
    bound, as per-group tables are broadcast. ``sketched`` may bring the groups'
    ``n`` and ``grid`` along.

    Returns the groups with ``target, rank, n, x_at, x_next`` (the values at
    the two ranks) and ``n_below``, the rows strictly below ``x_at``.
    """
    groups = list(groups)
    fixed = [*groups, "n"]
    cells = Window.partitionBy(*groups).orderBy("cell")
    cell = F.expr(_cell(0, 2 * many)).alias("cell")
    ensure_checkpoint_dir(values.sparkSession)
    if sketched is None:
        sketched = values.groupBy(*groups).agg(F.count("x").cast("bigint").alias("n"), _grid("x").alias("grid"))
    lows = _low("t.rank", "n", ends[0])
    highs = _high("t.next_rank", "n", ends[1])
    brackets = F.expr(f"transform({ranks}, t -> struct({lows} as low, {highs} as high))")
    narrow = sketched.withColumn("brackets", brackets).select(*fixed, _fences("brackets").alias("fences")).checkpoint()
    # A bracket spans five steps of the grid at most, besides copies of one value.
    inside = 5 * (narrow.agg(F.max("n")).collect()[0][0] or 0) / GRID
    while inside > FEW:
        narrow, inside = _narrowed(values, narrow, groups, ranks, many).checkpoint(), 5 * inside / GRID

    distinct = (
        join_on_keys(values, narrow, groups, small=True)
        .select(*fixed, "x", cell)
        .groupBy(*fixed, "cell", F.expr("if(cell % 2 = 1, x, null)").alias("x"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    offsets = (
        distinct.groupBy(*groups, "cell")
        .agg(F.sum("rows").alias("rows"))
        .select(*groups, "cell", (F.sum("rows").over(cells) - F.col("rows")).alias("before"))
    )
    running = Window.partitionBy(*groups, "cell").orderBy("x")
    missed = "raise_error('order statistics: a rank was missed')"
    return (
        join_on_keys(distinct.where("cell % 2 = 1"), offsets, [*groups, "cell"], small=True)
        .withColumn("upto", F.col("before") + F.sum("rows").over(running))
        .withColumn("t", F.expr(f"explode({ranks})"))
        .groupBy(*fixed, "t")
        .agg(
            F.expr("min(if(upto >= t.rank, x, null))").alias("x_at"),
            F.expr("min(if(upto >= t.next_rank, x, null))").alias("x_next"),
            F.expr("min(if(upto >= t.rank, upto - rows, null))").alias("n_below"),
            F.expr("min(if(upto >= t.next_rank, upto - rows, null))").alias("n_below_next"),
        )
        .where(f"if(n_below < t.rank and n_below_next < t.next_rank, true, {missed} is null)")
        .select(*groups, "t.target", "t.rank", "n", "x_at", "x_next", "n_below")
    )
