"""Small column expressions: levels, keys, rounding, status labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The label of a missing level, the separator of the display
# key, and the drift limits in percentage points with their labels.
NULL_LEVEL = "__NA__"
KEY_SEPARATOR = " | "
TWO_TIER = ((5.0, "OK"), (None, "DRIFT"))
THREE_TIER = ((2.0, "OK"), (5.0, "WATCH"), (None, "DRIFT"))

# Names starting with this prefix belong to the library.
INTERNAL = "_fd_"


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def name(column: str) -> str:
    """A column name as SQL text."""
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string literal as SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def level(value: str | Column) -> Column:
    """The value as text, with a missing value shown as its own level."""
    return F.coalesce(as_column(value).cast("string"), F.lit(NULL_LEVEL))


def display_key(strata: Sequence[str]) -> Column:
    """Readable stratum key. Grouping always uses the columns themselves,
    because two strata may share one display key."""
    return F.concat_ws(KEY_SEPARATOR, *[level(c) for c in strata])


def report_round(value: Column, digits: int) -> Column:
    scale = float(10**digits)
    return F.floor(value * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def status(diff_pct: Column, tiers: Sequence[tuple[float | None, str]]) -> Column:
    """Label of the first tier whose limit lies above the difference."""
    *limited, (_, last) = tiers
    labels = F.lit(last)
    for limit, label in reversed(limited):
        labels = F.when(diff_pct < F.lit(limit), F.lit(label)).otherwise(labels)
    return labels


def to_number(value: str | Column, is_numeric: bool = False) -> Column:
    """Number behind a text or numeric column; anything unreadable is 0."""
    column = as_column(value)
    number = column.cast("double") if is_numeric else column.cast("string").try_cast("double")
    return F.coalesce(F.nanvl(number, F.lit(0.0)), F.lit(0.0))


def only_if(condition: Column, value: Column) -> Column:
    """The value where the condition holds, null elsewhere."""
    return F.when(condition, value)


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """Column names of one kind: ``numeric``, ``text`` or ``other``."""
    kinds = {"numeric": T.NumericType, "text": T.StringType}
    if kind == "other":
        return [
            f.name
            for f in df.schema.fields
            if not isinstance(f.dataType, tuple(kinds.values()))
        ]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds[kind])]


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]
