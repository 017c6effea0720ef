"""Drawing the rows with the smallest priorities of each stratum, exactly.

A stratum may hold a third of the table, so no stratum as a whole may pass
through one task, and rows that are drawn need not be moved. So every draw
looks for cuts: the place, in the order of priorities, of each stratum's last
drawn row. Whole rows are then read once and compared with their stratum's cut.

* The share drawn tells where a cut lies up to random spread. One narrow pass
  counts the rows before that band and ranks the few rows inside it, a number
  that grows with the square root of the rows drawn. Should the cut miss the band, the counts say on
  which side it lies, and that side is ranked instead.
* With weights the band is found by counting rows along the scale of their
  waiting times, first coarsely, then finely inside the part with the cut.
* A small fixed number of rows per stratum needs no sizes and no band: each task
  keeps the first rows of every stratum it sees, so a hot stratum reaches its
  task as a few rows per task, and the last of the first rows is the cut.
* The ``BROADCAST_KEYS`` largest strata, and all others above ``LARGE_ROWS`` rows,
  of which a table has at most one per so many rows, have their cuts broadcast.
  Strata beyond them are small, however large the table: their narrow rows are ranked whole, and whole rows are joined with the cuts by a
  shuffle after a broadcast table of fixed size has dropped those beyond the
  largest cut of their group of strata.

The sizes of the strata and their cuts are tables of one row per stratum. They
are computed when a draw is asked for and checkpointed, so the plan of the
sample itself is one pass over the rows, however often it is used.

Strata and rows are known to the plans by 64-bit hashes (two for a stratum, the
priority and one more for a row), so tables that are broadcast have a bound in
bytes whatever the columns hold, and their columns cannot clash with any others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairdraw.functions.columns import INTERNAL, name, text
from fairdraw.functions.priority import (
    ABOVE_ALL,
    BELOW_ALL,
    hex_position,
    priority,
    weighted_priority,
)
from fairdraw.plans import copies
from fairdraw.plans.lookup import (
    BROADCAST_KEYS,
    GROUP,
    KEY,
    group_of,
    hash_of,
    in_groups_of,
    keyed,
    most_frequent,
)
from fairdraw.plans.quota import Quota, allocate, stratum_sizes
from fairdraw.sources.scratch import ensure_checkpoint_dir

# The columns that say how much of a stratum is drawn.
SIZE_COLUMNS = ("pop_n", "n_raw", "n_target", "n_take")

_HASH = INTERNAL + "hash"
_TIE = INTERNAL + "tie"
_ORDER = INTERNAL + "order"
_SPOT = INTERNAL + "spot"
_PLACE = INTERNAL + "place"
_CUT = INTERNAL + "cut"
_POP, _TAKE = INTERNAL + "pop", INTERNAL + "take"
_FLOOR, _CEILING = INTERNAL + "floor", INTERNAL + "ceiling"
_ROWS, _UPTO = INTERNAL + "rows", INTERNAL + "upto"
_OWN = {*KEY, GROUP, _HASH, _TIE, _ORDER, _SPOT, _PLACE, _CUT, _POP, _TAKE, _FLOOR, _CEILING, _ROWS, _UPTO, *copies.OWN}
_SAME_IDS = "the id columns do not tell rows apart; leave ids out for such tables"
# Rows per stratum up to which a task may keep the first ones of each.
FEW_ROWS = 10_000
# Rows of a stratum above which it is never ranked whole in one task.
LARGE_ROWS = 1 << 18
# Priorities below this, one part in 256 of them, are ranked first.
_NEAR = "01"
# Rows of small strata, about, up to which their first rows are ranked as a whole.
_FEW_WHOLE = 4_000_000
# Steps of the scale of waiting times: coarse ones per doubling, fine ones in each.
_COARSE, _FINE = 8, 65_536


def _edge(deviations: int, rows: int) -> str:
    """SQL text of the priority a number of standard deviations and rows away
    from the share drawn; negative numbers lead below it."""
    share = f"({_TAKE} / {_POP})"
    away = f"({deviations} * sqrt({_POP} * {share} * (1 - {share})) + {rows})"
    return hex_position(f"({share} + {away} / {_POP})")


def _located(narrow: DataFrame, zones: DataFrame) -> DataFrame:
    """The zones with the cut where it lies in the zone, else null, the rows
    ``below`` the zone, and the rows ``reached`` by its end."""
    inside = narrow.join(F.broadcast(zones), KEY).where(f"{_SPOT} < {_CEILING}")
    # All rows below a zone are one row with a null place by now.
    counted = inside.groupBy(*KEY, _TAKE, F.expr(f"if({_SPOT} < {_FLOOR}, null, {_PLACE})").alias(_PLACE)).agg(
        F.count(F.lit(1)).alias(_ROWS)
    )
    return zones.join(_at_cut(counted), KEY, "left")


def _at_cut(counted: DataFrame) -> DataFrame:
    """Per stratum the place of the last drawn row, from the rows at each place."""
    window = Window.partitionBy(*KEY).orderBy(F.asc_nulls_first(_PLACE)).rowsBetween(Window.unboundedPreceding, 0)
    message = text(_SAME_IDS)
    crossing = f"{_PLACE} is not null and {_UPTO} - {_ROWS} < {_TAKE} and {_UPTO} >= {_TAKE}"
    place = f"case when not ({crossing}) then null when {_UPTO} > {_TAKE} then raise_error({message}) else {_PLACE} end"
    return (
        counted.withColumn(_UPTO, F.sum(_ROWS).over(window))
        .groupBy(*KEY)
        .agg(
            F.max(F.expr(place)).alias(_CUT),
            F.expr(f"sum(if({_PLACE} is null, {_ROWS}, 0))").alias("below"),
            F.max(_UPTO).alias("reached"),
        )
    )


def _cuts(narrow: DataFrame, partly: DataFrame) -> DataFrame:
    """Cuts of the strata drawn in part, by their priorities."""
    guess = partly.select(
        *KEY, _TAKE, F.expr(_edge(-8, -40)).alias(_FLOOR), F.expr(_edge(8, 40)).alias(_CEILING)
    )
    located = _located(narrow, guess).checkpoint()
    missed = located.where(f"{_CUT} is null")
    if missed.isEmpty():
        return located.select(*KEY, _CUT)
    # The counts say on which side of the zone the cut lies.
    zones = missed.select(
        *KEY,
        _TAKE,
        F.expr(f"if(below >= {_TAKE}, {text(BELOW_ALL)}, {_CEILING})").alias(_FLOOR),
        F.expr(f"if(below >= {_TAKE}, {_FLOOR}, {text(ABOVE_ALL)})").alias(_CEILING),
    )
    rest = _located(narrow, zones).checkpoint()
    return located.where(f"{_CUT} is not null").unionByName(rest).select(*KEY, _CUT)


def _crossing(narrow: DataFrame, zones: DataFrame, step: str, inside: str) -> DataFrame:
    """Per stratum the step of a scale that holds the last drawn row. ``zones``
    has the rows before it as ``_UPTO``."""
    counted = (
        narrow.join(F.broadcast(zones), KEY)
        .where(inside)
        .groupBy(*KEY, _TAKE, F.col(_UPTO).alias("before"), F.expr(step).alias(_FLOOR))
        .agg(F.count(F.lit(1)).alias(_ROWS))
    )
    window = Window.partitionBy(*KEY).orderBy(_FLOOR).rowsBetween(Window.unboundedPreceding, 0)
    upto = counted.withColumn(_UPTO, F.col("before") + F.sum(_ROWS).over(window))
    return upto.where(f"{_UPTO} - {_ROWS} < {_TAKE} and {_UPTO} >= {_TAKE}").select(
        *KEY, _TAKE, _FLOOR, F.expr(f"{_UPTO} - {_ROWS}").alias(_UPTO)
    )


def _cuts_weighted(narrow: DataFrame, partly: DataFrame) -> DataFrame:
    """Cuts by waiting times, whose distribution depends on the weights."""
    start = partly.select(*KEY, _TAKE, F.lit(0).cast("bigint").alias(_UPTO))
    coarse = _crossing(narrow, start, f"{_SPOT} div {_FINE}", "true")
    fine = _crossing(narrow, coarse, _SPOT, f"{_SPOT} div {_FINE} = {_FLOOR}")
    zones = fine.select(*KEY, _TAKE, _FLOOR, F.expr(f"{_FLOOR} + 1").alias(_CEILING))
    return _located(narrow, zones).checkpoint().select(*KEY, _CUT)


def _limited(rows: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of every stratum with their rank. Spark limits the
    groups of a rank inside every task before it shuffles them."""
    place = [F.col(f"{_PLACE}.{c}") for c in rows.schema[_PLACE].dataType.names]
    rank = F.row_number().over(Window.partitionBy(*KEY).orderBy(*place))
    return rows.withColumn(_ROWS, rank).where(f"{_ROWS} <= {n}")


def _first_cuts(narrow: DataFrame, n: int) -> DataFrame:
    """Per stratum the place of its ``n``-th row; null where it has fewer."""
    ends = _limited(narrow, n + 1).groupBy(*KEY).agg(
        F.max(F.expr(f"if({_ROWS} = {n}, {_PLACE}, null)")).alias(_CUT),
        F.max(F.expr(f"if({_ROWS} = {n + 1}, {_PLACE}, null)")).alias(_CEILING),
    )
    return ends.select(*KEY, F.expr(f"if({_CUT} = {_CEILING}, raise_error({text(_SAME_IDS)}), {_CUT})").alias(_CUT))


def _first_by_hash(marked: DataFrame, n: int, broadcast_keys: int) -> DataFrame | None:
    """The first ``n`` rows of every stratum by their priorities. Most strata that
    are large have them among the rows with small priorities, of which the first
    ones are kept whole; only rows of the other strata are looked at again. How
    many rows these have follows from how many of them were small."""
    top = _limited(marked.where(f"{_HASH} < {text(_NEAR)}"), n + 1).checkpoint()
    full = top.where(f"{_ROWS} = {n + 1}").select(*KEY, F.col(_PLACE).alias(_CEILING))
    strata, kept = top.agg(F.expr(f"count_if({_ROWS} = {n + 1})"), F.count(F.lit(1))).collect()[0]
    if strata > broadcast_keys:
        return _first_rows(marked, n, broadcast_keys)
    known = top.where(f"{_ROWS} <= {n}").join(F.broadcast(full), KEY)
    same = f"if({_ROWS} = {n} and {_PLACE} = {_CEILING}, raise_error({text(_SAME_IDS)}), true)"
    drawn = known.where(same).select(*marked.columns)
    rest = marked.join(F.broadcast(full.select(*KEY)), KEY, "left_anti")
    if (kept - strata * (n + 1)) * 16 ** len(_NEAR) <= _FEW_WHOLE:
        few = _limited(rest, n + 1)
        before = F.lag(_PLACE).over(Window.partitionBy(*KEY).orderBy(_ROWS))
        few = few.withColumn(_CEILING, before).where(
            f"if({_ROWS} = {n + 1}, if({_PLACE} = {_CEILING}, raise_error({text(_SAME_IDS)}), false), true)"
        )
    else:
        few = _first_rows(rest, n, broadcast_keys)
    return drawn if few is None else drawn.unionByName(few.select(*marked.columns))


def _first_rows(marked: DataFrame, n: int, broadcast_keys: int) -> DataFrame | None:
    """The first ``n`` rows of every stratum, None if there is no stratum."""
    cuts = _first_cuts(marked.select(*KEY, _PLACE), n).checkpoint()
    if cuts.isEmpty():
        return None
    larger = cuts.where(f"{_CUT} is not null")
    if larger.count() <= broadcast_keys:
        # A stratum without a cut is drawn whole.
        return marked.join(F.broadcast(larger), KEY, "left").where(f"{_CUT} is null or {_PLACE} <= {_CUT}")
    # The smaller the cut, the larger the stratum.
    head = larger.orderBy(_CUT, *KEY).limit(broadcast_keys).checkpoint()
    drawn = marked.join(F.broadcast(head), KEY).where(f"{_PLACE} <= {_CUT}")
    tail = cuts.join(F.broadcast(head.select(*KEY)), KEY, "left_anti")
    bounds = tail.groupBy(group_of().alias(GROUP)).agg(
        F.max(_CUT).alias(_CEILING), F.expr(f"bool_or({_CUT} is null)").alias(_UPTO)
    )
    rest = marked.withColumn(GROUP, group_of()).join(F.broadcast(bounds), GROUP)
    rest = rest.join(F.broadcast(head.select(*KEY)), KEY, "left_anti").where(f"{_UPTO} or {_PLACE} <= {_CEILING}")
    near = rest.drop(_UPTO, _CEILING).join(tail, KEY).where(f"{_CUT} is null or {_PLACE} <= {_CUT}")
    return drawn.select(*marked.columns).unionByName(near.select(*marked.columns))


def draw(
    rows: DataFrame,
    strata: Sequence[str],
    quota: Quota,
    *,
    ids: Sequence[str] | None = None,
    seed: int = 42,
    weight: str | Column | None = None,
    sizes: DataFrame | None = None,
    keep_sizes: bool = False,
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """Draw the rows of a stratified sample. Runs jobs for the cuts.

    ``rows`` is read several times and must be the same each time; write or
    checkpoint a table that is not. ``ids`` must tell rows apart: where equal
    ids would decide a cut, the job stops, however small the stratum. Without
    them equal rows are numbered where they are, which costs narrow passes.
    ``sizes`` may bring the stratum sizes along; ``keep_sizes`` adds ``pop_n``
    and ``n_take`` to the result.
    """
    strata = list(strata)
    clashes = {c for c in (rows.columns if keep_sizes else strata) if c.lower() in SIZE_COLUMNS}
    clashes |= {c for c in rows.columns if c.lower() in _OWN}
    if clashes:
        raise ValueError(f"rename these columns first: {sorted(clashes)}")
    columns, given = rows.columns, rows
    if ids is None:
        rows = copies.number_copies(rows)
        ids = rows.columns
    marked = keyed(rows, strata).withColumns({_HASH: priority(seed, ids), _TIE: hash_of(ids, "row")})
    if weight is None:
        marked = marked.withColumns({_SPOT: F.col(_HASH), _PLACE: F.struct(_HASH, _TIE)})
    else:
        amount = (F.col(weight) if isinstance(weight, str) else weight).cast("double")
        marked = marked.withColumn(_ORDER, weighted_priority(_HASH, amount))
        # Steps of the scale, moved so that none is negative.
        spot = f"cast(floor((greatest(coalesce(log2({_ORDER}), -2000D), -2000D) + 2000) * {_COARSE * _FINE}) as bigint)"
        marked = marked.withColumns({_SPOT: F.expr(spot), _PLACE: F.struct(_ORDER, _HASH, _TIE)})

    ensure_checkpoint_dir(rows.sparkSession)
    plain = quota.n is not None and not quota.boost_levels and quota.boost_below is None and quota.drop_below is None
    first = max(quota.n or 0, quota.min_rows)
    if plain and first <= FEW_ROWS and not keep_sizes:
        drawn = (_first_by_hash if weight is None else _first_rows)(marked, first, broadcast_keys)
        return (marked.where("false") if drawn is None else drawn).select(*[F.col(name(c)) for c in columns])
    sizes = stratum_sizes(given, strata) if sizes is None else sizes
    if quota.total is not None:
        sizes = sizes.checkpoint()
    allocation = keyed(allocate(sizes, quota), strata).select(
        *KEY, F.col("pop_n").alias(_POP), F.col("n_take").alias(_TAKE)
    ).checkpoint()
    number, large = allocation.agg(F.count(F.lit(1)), F.expr(f"count_if({_POP} > {LARGE_ROWS})")).collect()[0]
    broadcast_keys = max(broadcast_keys, large)
    head, tail = (allocation, None) if number <= broadcast_keys else most_frequent(allocation, _POP, broadcast_keys)

    narrow = marked.select(*KEY, _SPOT, _PLACE)
    partly = head.where(f"{_TAKE} > 0 and {_TAKE} < {_POP}")
    cuts = (_cuts if weight is None else _cuts_weighted)(narrow, partly)
    size_columns = [_POP, _TAKE] if keep_sizes else []
    # A stratum without a cut here is drawn whole.
    known = head.where(f"{_TAKE} > 0").join(F.broadcast(cuts), KEY, "left").select(
        *KEY, *size_columns, _CUT, F.expr(f"{_TAKE} = {_POP}").alias(_UPTO)
    )
    drawn = marked.join(F.broadcast(known), KEY).where(f"{_UPTO} or {_PLACE} <= {_CUT}")

    chosen = [*[F.col(name(c)) for c in columns], *[F.col(c).alias(n) for c, n in zip(size_columns, ("pop_n", "n_take"), strict=False)]]
    if tail is None:
        return drawn.select(*chosen)

    tail = tail.where(f"{_TAKE} > 0").checkpoint()
    few = in_groups_of(narrow, tail).join(tail, KEY)
    tail_cuts = _at_cut(few.groupBy(*KEY, _TAKE, _PLACE).agg(F.count(F.lit(1)).alias(_ROWS))).select(*KEY, _CUT).checkpoint()
    bounds = tail_cuts.groupBy(group_of().alias(GROUP)).agg(F.max(_CUT).alias(_FLOOR))
    near = marked.withColumn(GROUP, group_of()).join(F.broadcast(bounds), GROUP).where(f"{_PLACE} <= {_FLOOR}")
    rest = near.join(tail_cuts.join(tail, KEY) if keep_sizes else tail_cuts, KEY).where(f"{_PLACE} <= {_CUT}")
    return drawn.select(*chosen).unionByName(rest.select(*chosen))
