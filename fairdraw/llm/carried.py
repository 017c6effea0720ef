"""Columns of given tables that operators carry along."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names that begin so belong to the operators.
RESERVED = "__"


def carried(docs: DataFrame, made: Sequence[str] = ()) -> tuple[list[str], list[Column]]:
    """Names of the columns to carry along, and the columns, whatever characters
    their names have. Columns that the operator ``made``, in any case of letters,
    are replaced by its own; reserved names are refused."""
    bad = [c for c in docs.columns if c.startswith(RESERVED)]
    if bad:
        raise ValueError(f"rename these columns first: {bad}")
    own = {c.lower() for c in made}
    names = [c for c in docs.columns if c.lower() not in own]
    return names, [F.col("`" + c.replace("`", "``") + "`") for c in names]
