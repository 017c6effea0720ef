"""How many rows each stratum contributes, computed from its size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairdraw.functions.columns import INTERNAL
from fairdraw.plans.lookup import join_on_keys
from fairdraw.sources.scratch import ensure_checkpoint_dir

_BOOSTED = INTERNAL + "boosted"
_ROWS = INTERNAL + "rows"
_EXACT, _REST = INTERNAL + "exact", INTERNAL + "rest"
_STEP, _OPEN = INTERNAL + "step", INTERNAL + "open"
_STEPS = 65_536
_LOW, _HIGH, _GIVEN = INTERNAL + "low", INTERNAL + "high", INTERNAL + "given"
# Whole numbers in which sizes are multiplied without a loss.
_WIDE = "decimal(38, 0)"


@dataclass(frozen=True)
class Quota:
    """One of ``pct`` (share of each stratum), ``n`` (rows of each stratum) or
    ``total`` (rows of the whole sample, spread in proportion to size).

    ``min_rows`` is the guaranteed minimum; a stratum never gives more rows
    than it has, nor more than ``max_rows``. Strata under ``boost_below`` rows and
    strata holding one of ``boost_levels`` (column to levels) are taken whole, up
    to ``max_rows``. Strata under ``drop_below`` rows are left out.

    A total is met exactly, or as nearly as all strata's most rows allow: strata
    get their whole rows, and the largest remainders one more, ties in the order of
    the strata. Minimum, boosts, most rows and dropped strata are bounds within
    which the total is spread: the others share what is left in proportion to
    their sizes. A total below the sum of the least rows is refused. With
    ``total_digits`` the share that the total stands for is rounded instead, and
    then each stratum on its own; bounds then change the total.
    """

    pct: float | None = None
    n: int | None = None
    total: int | None = None
    min_rows: int = 0
    boost_below: int | None = None
    boost_levels: Mapping[str, Sequence] = field(default_factory=dict)
    drop_below: int | None = None
    max_rows: int | None = None
    total_digits: int | None = None

    def __post_init__(self) -> None:
        if [self.pct, self.n, self.total].count(None) != 2:
            raise ValueError("give exactly one of pct, n and total")
        if self.pct is not None and not 0 < self.pct < 1:
            raise ValueError("pct must lie between 0 and 1, both excluded")
        if self.n is not None and self.n < 1:
            raise ValueError("n must be at least 1")
        if self.total is not None and self.total < 1:
            raise ValueError("total must be at least 1")
        if self.min_rows < 0:
            raise ValueError("min_rows must not be negative")
        if self.max_rows is not None and self.max_rows < max(1, self.min_rows):
            raise ValueError("max_rows must be at least 1, and at least min_rows")

    @property
    def is_bounded(self) -> bool:
        """Whether strata have bounds other than their sizes."""
        return bool(self.min_rows or self.boost_below is not None or self.boost_levels or self.drop_below or self.max_rows)

    def boosted(self) -> Column:
        found = F.lit(False)
        if self.boost_below is not None:
            found = found | (F.col("pop_n") < self.boost_below)
        for column, levels in self.boost_levels.items():
            found = found | F.coalesce(F.col(column).isin(list(levels)), F.lit(False))
        return found

    def apply(self, table: DataFrame, sizes: DataFrame) -> DataFrame:
        """Add ``n_raw``, ``n_target`` and ``n_take`` to a table with ``pop_n``.

        Rounding is half to even. A total needs the population size, which is
        a scalar subquery over the sizes.
        """
        exact = self.total is not None and self.total_digits is None
        if exact:
            table = _with_remainders(table, sizes, self.total)
        table = table.withColumn(_BOOSTED, self.boosted())

        if self.n is not None:
            raw = f"cast({self.n} as bigint)"
        elif self.pct is not None:
            raw = f"cast(rint(pop_n * {float(self.pct)!r}D) as bigint)"
        elif self.total_digits is None:
            raw = _EXACT
        else:
            rows = sizes.agg(F.sum("pop_n").alias("rows")).scalar()
            table = table.withColumn(_ROWS, rows)
            share = f"({float(self.total)!r}D / {_ROWS})"
            scale = f"{float(10**self.total_digits)!r}D"
            share = f"(rint({share} * {scale}) / {scale})"
            raw = f"cast(rint(pop_n * {share}) as bigint)"
        dropped = f"pop_n < {self.drop_below}" if self.drop_below is not None else "false"
        most = "pop_n" if self.max_rows is None else f"least(pop_n, {self.max_rows}L)"
        if exact and self.is_bounded:
            table = table.withColumns({_LOW: F.expr(self._least(dropped, most)), _HIGH: F.expr(f"if({dropped}, 0L, {most})")})
            return _within_bounds(table.withColumn("n_raw", F.expr(raw)), sizes, self).drop(_BOOSTED, _ROWS, _EXACT, _LOW, _HIGH)
        return table.selectExpr(
            "*",
            f"{raw} as n_raw",
            f"""case when {dropped} then 0L
                     when {_BOOSTED} then greatest(n_raw, {self.min_rows}, pop_n)
                     else greatest(n_raw, {self.min_rows}) end as n_target""",
            f"least(n_target, {most}) as n_take",
        ).drop(_BOOSTED, _ROWS, _EXACT)

    def _least(self, dropped: str, most: str) -> str:
        """SQL text of the rows a stratum gives at least."""
        return f"case when {dropped} then 0L when {_BOOSTED} then {most} else least({self.min_rows}L, {most}) end"


def _multiplier(strata: DataFrame, total: int) -> Fraction:
    """The share of their sizes that strata without a binding bound give, so that
    all together give the total.

    What the strata give grows with the share along straight pieces. Each step
    adds the strata up once, exactly, and goes to where the piece it is on would
    meet the total, or to the middle of the shares still possible.
    """
    low, high = Fraction(0), Fraction(1)
    rows = strata.agg(F.sum("pop_n")).collect()[0][0] or 1
    share = min(Fraction(total, rows), high)
    while True:
        p, q = share.numerator, share.denominator
        wanted = f"(cast(pop_n as {_WIDE}) * {p})"
        at_low, at_high = f"{_LOW} * cast({q} as {_WIDE}) >= {wanted}", f"{_HIGH} * cast({q} as {_WIDE}) <= {wanted}"
        row = strata.agg(
            F.expr(f"coalesce(sum(case when {at_low} then {_LOW} when {at_high} then {_HIGH} end), 0) as fixed"),
            F.expr(f"coalesce(sum(if({at_low} or {at_high}, null, pop_n)), 0) as free"),
        ).collect()[0]
        given = row["fixed"] + share * row["free"]
        if given == total:
            return share
        low, high = (share, high) if given < total else (low, share)
        there = Fraction(total - row["fixed"], row["free"]) if row["free"] else low
        middle = Fraction((low.numerator << 40) // low.denominator + (high.numerator << 40) // high.denominator, 1 << 41)
        if low < there < high:
            share = there
        elif low < middle < high:
            share = middle
        else:
            # Only for bounds closer together than one part in 2^41 of a stratum.
            share = (low + high) / 2


def _within_bounds(table: DataFrame, sizes: DataFrame, quota: Quota) -> DataFrame:
    """Add ``n_target`` and ``n_take`` between ``_LOW`` and ``_HIGH`` that sum to
    the total."""
    ensure_checkpoint_dir(sizes.sparkSession)
    table = table.checkpoint()
    least, most = table.agg(F.sum(_LOW), F.sum(_HIGH)).collect()[0]
    total = min(quota.total, most or 0)
    if total < (least or 0):
        raise ValueError(f"the least rows of all strata are {least}, more than the total")
    share = Fraction(int(total == most)) if total in (least, most) else _multiplier(table, total)
    p, q = share.numerator, share.denominator
    keys = [c for c in sizes.columns if c != "pop_n"]
    wanted, scaled = f"(cast(pop_n as {_WIDE}) * {p})", f"cast({q} as {_WIDE})"
    fixed = f"case when {_LOW} * {scaled} >= {wanted} then {_LOW} when {_HIGH} * {scaled} <= {wanted} then {_HIGH} end"
    marked = table.withColumn(_GIVEN, F.expr(fixed))
    free = marked.where(f"{_GIVEN} is null").select(
        *keys,
        F.expr(f"cast({wanted} div {scaled} as bigint)").alias(_EXACT),
        F.expr(f"{wanted} % {scaled}").alias(_REST),
        F.expr(f"cast({wanted} % {scaled} * {_STEPS} div {scaled} as int)").alias(_STEP),
    )
    held = marked.agg(F.coalesce(F.sum(_GIVEN), F.lit(0))).collect()[0][0]
    rounded = _largest_first(free, keys, F.lit(total - held))
    chosen = join_on_keys(marked.drop(_EXACT), rounded, keys, "left")
    return chosen.withColumn("n_target", F.coalesce(_EXACT, _GIVEN)).withColumn("n_take", F.col("n_target")).drop(_EXACT, _GIVEN)


def _with_remainders(table: DataFrame, sizes: DataFrame, total: int) -> DataFrame:
    """Add the rows of each stratum that together make the total.

    Which remainders are the largest is found by counting them in ``_STEPS``
    steps; only the strata of one step are put in order."""
    keys = [c for c in sizes.columns if c != "pop_n"]
    exact = sizes.withColumn(_ROWS, sizes.agg(F.sum("pop_n").alias("rows")).scalar()).withColumn(
        _EXACT, F.expr(f"cast(pop_n as {_WIDE}) * least({total}L, {_ROWS})")
    )
    parts = exact.withColumns(
        {
            _REST: F.expr(f"{_EXACT} % {_ROWS}"),
            _EXACT: F.expr(f"cast({_EXACT} div {_ROWS} as bigint)"),
            _STEP: F.expr(f"cast(({_EXACT} % {_ROWS}) * {_STEPS} div {_ROWS} as int)"),
        }
    )
    return join_on_keys(table, _largest_first(parts, keys, F.least(F.lit(total), "rows")), keys)


def _largest_first(parts: DataFrame, keys: Sequence[str], total: Column) -> DataFrame:
    """Raise ``_EXACT`` by one where ``_REST`` is largest, until it sums to the
    total, an expression that may use the largest ``_ROWS`` as ``rows``."""
    rows = F.max(_ROWS).alias("rows") if _ROWS in parts.columns else F.lit(None).alias("rows")
    counts = parts.groupBy(_STEP).agg(F.count(F.lit(1)).alias("strata"), F.sum(_EXACT).alias("given"), rows)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    higher = Window.orderBy(F.desc(_STEP)).rowsBetween(Window.unboundedPreceding, -1)
    # At most _STEPS rows.
    left = counts.withColumn("missing", total - F.sum("given").over(everything)).select(
        F.col(_STEP), (F.col("missing") - F.coalesce(F.sum("strata").over(higher), F.lit(0))).alias(_OPEN), "strata"
    )
    known = parts.join(F.broadcast(left), _STEP)
    sure = known.where(f"{_OPEN} <= 0 or {_OPEN} >= strata").withColumn(_EXACT, F.expr(f"{_EXACT} + if({_OPEN} > 0, 1, 0)"))
    order = Window.partitionBy(_STEP).orderBy(F.desc(_REST), *[F.asc_nulls_first(c) for c in keys])
    split = known.where(f"{_OPEN} > 0 and {_OPEN} < strata").withColumn("place", F.row_number().over(order))
    split = split.withColumn(_EXACT, F.expr(f"{_EXACT} + if(place <= {_OPEN}, 1, 0)"))
    return sure.select(*keys, _EXACT).unionByName(split.select(*keys, _EXACT))


def stratum_sizes(df: DataFrame, strata: Sequence[str]) -> DataFrame:
    """Rows per stratum; nulls form strata of their own. Map-side combining
    leaves one row per stratum and task for the shuffle, hot strata included."""
    return df.groupBy(*strata).agg(F.count(F.lit(1)).alias("pop_n"))


def allocate(sizes: DataFrame, quota: Quota) -> DataFrame:
    """Allocation table: sizes with the rows wanted and taken per stratum."""
    return quota.apply(sizes, sizes).selectExpr(
        "*", f"n_raw < {quota.min_rows} as is_floored", "n_target > pop_n as is_capped"
    )
