"""Random priorities that depend only on the seed and the row's identity.

The same row gets the same priority under any partitioning, after any retry
and in any engine that has md5, so a sample can be repeated exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fairdraw.functions.columns import NULL_LEVEL, name, text

HEX_DIGITS = 13
RESOLUTION = 16**HEX_DIGITS
# Compare below and above every priority.
BELOW_ALL = ""
ABOVE_ALL = "g"
# Beyond the waiting time of any weight in use.
AFTER_ALL, LONGEST = 1e300, 1e299


def priority(seed: int, ids: Sequence[str]) -> Column:
    """32 hexadecimal digits, uniformly distributed; the smallest are drawn."""
    parts = [f"coalesce(cast({name(c)} as string), {text(NULL_LEVEL)})" for c in ids]
    return F.expr(f"md5(concat_ws('|', {', '.join([text(str(seed)), *parts])}))")


def uniform(digits: str) -> Column:
    """A number in [0, 1) from the leading digits of a priority column."""
    return F.expr(f"cast(conv(substring({name(digits)}, 1, {HEX_DIGITS}), 16, 10) as double) / {RESOLUTION}")


def weighted_priority(digits: str, weight: Column) -> Column:
    """Exponential waiting time with the weight as its rate, so the rows with
    the smallest values form a draw without replacement in which heavier
    rows come first. Equal weights keep the order of the plain priorities;
    rows without a positive weight come last, in the order of the priorities."""
    known = (weight > 0) & ~F.isnan(weight)
    # The smallest weights wait equally long, then in the order of the priorities.
    waiting = F.least(-F.log(1 - uniform(digits)) / weight, F.lit(LONGEST))
    return F.when(known, waiting).otherwise(
        F.lit(AFTER_ALL) * (1 + uniform(digits))
    )


def hex_position(share: str) -> str:
    """SQL text of the hex digits at a share of the priority range, which
    priorities compare with as text."""
    return f"""case when {share} >= 1 then {text(ABOVE_ALL)}
                    when {share} <= 0 then {text(BELOW_ALL)}
                    else lower(lpad(hex(cast(floor({share} * {RESOLUTION}) as bigint)), {HEX_DIGITS}, '0'))
               end"""
