"""Samples of a table taken chunk by chunk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairdraw.operators.positions import row_position
from fairdraw.plans.quota import Quota
from fairdraw.plans.selection import draw


def chunk_of_position(
    df: DataFrame, order_by: Sequence[str], chunk_rows: int, name: str = "chunk_id", *, ids: Sequence[str] = ()
) -> DataFrame:
    """Number consecutive chunks of ``chunk_rows`` rows under an order, from 0.
    Chunks by the rows' place in their files need no sort: see
    :func:`fairdraw.operators.positions.file_chunk`."""
    if chunk_rows < 1:
        raise ValueError("chunk_rows must be at least 1")
    numbered = row_position(df, order_by, name, ids=ids)
    return numbered.withColumn(name, F.expr(f"({name} - 1) div {chunk_rows}"))


def chunk_sample(
    df: DataFrame,
    strata: Sequence[str],
    chunk: Column,
    pct: float,
    min_rows: int = 1,
    *,
    floor_scope: str = "chunk",
    ids: Sequence[str] | None = None,
    seed: int = 42,
) -> DataFrame:
    """Sample every chunk on its own, with the chunk number as ``chunk_id``.

    The chunk is one more stratum column, so all chunks are drawn in one job.
    A column of that name is replaced.
    With ``floor_scope="chunk"`` the floor holds in each chunk, which lifts
    rare strata; with ``"global"`` shares and floor refer to the whole table.
    """
    if floor_scope not in ("chunk", "global"):
        raise ValueError("floor_scope must be 'chunk' or 'global'")
    if min_rows < 1:
        raise ValueError("min_rows must be at least 1")
    if "chunk_id" in strata:
        raise ValueError("rename the stratum column chunk_id first")
    chunked = df.withColumn("chunk_id", chunk)
    groups = ["chunk_id", *strata] if floor_scope == "chunk" else list(strata)
    if ids is None:
        drawn = draw(chunked, groups, Quota(pct=pct, min_rows=min_rows), seed=seed)
        return drawn
    return draw(chunked, groups, Quota(pct=pct, min_rows=min_rows), ids=ids, seed=seed)
