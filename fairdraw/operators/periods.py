"""Samples of several periods, joined without repeating an entity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairdraw.functions.columns import INTERNAL
from fairdraw.functions.priority import priority
from fairdraw.plans.lookup import KEY, keyed
from fairdraw.plans.quota import Quota
from fairdraw.plans.selection import draw
from fairdraw.sources.scratch import ensure_checkpoint_dir

_TURN = INTERNAL + "turn"
_HASH = INTERNAL + "hash"
_GROUP = INTERNAL + "group"
# Groups of entities, by their hashes.
GROUPS = 1 << 20


def first_per_entity(
    df: DataFrame, entity: Sequence[str], order: Sequence[str], ids: Sequence[str], seed: int = 42
) -> DataFrame:
    """One row per entity: the first by ``order``, then by priority.

    Most entities have one row. A narrow count of the hashes of entities finds
    those with several; a broadcast table of ``GROUPS`` numbers at most tells
    which rows may be theirs. All others stay where they are. Of those ranked,
    each task keeps one row per entity before the shuffle, so a frequent entity
    does not gather in one task.
    """
    marked = keyed(df, entity)
    several = marked.groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    group = F.expr(f"pmod({KEY[0]}, {GROUPS})")
    groups = F.broadcast(several.select(group.alias(_GROUP)).distinct())
    grouped = marked.withColumn(_GROUP, group)
    alone = grouped.join(groups, _GROUP, "left_anti")
    ranked = grouped.join(groups, _GROUP, "left_semi").withColumn(_HASH, priority(seed, ids))
    window = Window.partitionBy(*entity).orderBy(*order, _HASH, *ids)
    rank = INTERNAL + "rank"
    first = ranked.withColumn(rank, F.row_number().over(window)).where(f"{rank} = 1")
    return alone.select(*df.columns).unionByName(first.select(*df.columns))


def period_sample(
    periods: Sequence[tuple[str, DataFrame, Sequence[str]]],
    quota: Quota,
    entity: Sequence[str],
    *,
    ids: Sequence[str],
    seed: int = 42,
) -> DataFrame:
    """Sample each ``(name, table, strata)`` and keep one row per entity, from
    the earliest period that drew it. The period's name is the column
    ``period``; columns a period lacks are null.

    The rows drawn are checkpointed, as telling entities apart takes several passes
    over them, each of which would otherwise read and draw from all tables again."""
    drawn = [
        draw(table, strata, quota, ids=ids, seed=seed)
        .withColumn("period", F.lit(label))
        .withColumn(_TURN, F.lit(turn))
        for turn, (label, table, strata) in enumerate(periods)
    ]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), drawn)
    ensure_checkpoint_dir(together.sparkSession)
    return first_per_entity(together.checkpoint(), entity, [_TURN], ids, seed).drop(_TURN)


def id_list(sample: DataFrame, entity: Sequence[str]) -> DataFrame:
    """The sampled entities only."""
    return sample.select(*entity)
