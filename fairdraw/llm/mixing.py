"""Mixing sources to target weights by budgets handed down a tree.

The tree is domain, language, source; its leaves hold documents. A node's
capacity is what its leaves can give in ``max_epochs`` readings. The budget of a
node goes to its children by weight. A child that cannot use its share keeps
its capacity and the shortage is shared by its siblings, again by weight; only
what no child can use stays open in the node above, whose own share was
bounded by that capacity for the same reason. Everything is integer arithmetic;
rounding leaves less than one token per child unused.

A leaf is read in epochs, each in an order of its own that depends on the seed
and the ids only. Full epochs give every document, the last one the documents
at its start as long as their tokens fit. The place of the cut is found by
adding up tokens per leading digits of the ordering hash, two digits at a time,
so no leaf passes through one task; then one pass without a shuffle of whole
rows compares every document with its leaf's cut.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fairdraw.llm.carried import carried
from fairdraw.llm.storage import new_folder, written

LEVELS = ("domain", "lang", "source")
#: Whitespace-separated words stand for tokens unless the caller counts others.
TOKENS = r"coalesce(cast(regexp_count(text, '[^\\x20\\x09-\\x0D]+') as bigint), 0)"
_DIGITS, _STEPS = 2, 3
_NODE = [f"__node_{level}" for level in LEVELS]


@dataclass(frozen=True)
class Mix:
    """What to mix. ``domain`` is SQL text for a document's domain. Weights are
    whole numbers by name, 1 where none is given. The budget is a share of the
    tokens, in thousandths. Every leaf is read ``max_epochs`` times at most."""

    domain: str
    weights: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    budget_permille: int = 600
    max_epochs: int = 1
    seed: int = 42


def _weight(mix: Mix, level: str) -> Column:
    known = mix.weights.get(level, {})
    if not known:
        return F.lit(1).cast("bigint")
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.coalesce(table[F.expr(f"substr(__node_{level}, 2)")], F.lit(1)).cast("bigint")


def _share_out(children: DataFrame, parent: list[str], key: str) -> DataFrame:
    """Give each child its part of the parent's ``budget``: columns of
    ``children`` (``capacity``, ``weight``, ``budget``) with the child's own
    budget instead."""
    by_need = Window.partitionBy(*parent).orderBy(
        F.expr("if(weight > 0, capacity / weight, null)").asc_nulls_last(), key
    )
    earlier, siblings = by_need.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*parent)
    big = "decimal(20, 0)"
    laid = children.withColumns(
        {
            "__all": F.sum("weight").over(siblings),
            "__weight": F.coalesce(F.sum("weight").over(earlier), F.lit(0)),
            "__taken": F.coalesce(F.sum("capacity").over(earlier), F.lit(0)),
        }
    ).withColumn(
        "__full",
        F.expr(
            f"cast(capacity as {big}) * cast(__all - __weight as decimal(18, 0))"
            f" <= cast(weight as decimal(18, 0)) * cast(budget - __taken as {big})"
        ),
    )
    rest = laid.withColumns(
        {
            "__rest": F.col("budget") - F.sum(F.expr("if(__full, capacity, 0)")).over(siblings),
            "__open": F.sum(F.expr("if(__full, 0, weight)")).over(siblings),
        }
    )
    own = (
        f"if(__full, capacity, if(weight = 0 or __open = 0, 0,"
        f" cast(weight as decimal(18, 0)) * cast(__rest as {big}) div cast(__open as {big})))"
    )
    return rest.withColumn("budget", F.expr(own)).drop("__all", "__weight", "__taken", "__full", "__rest", "__open")


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """Per leaf (``leaves``: the node columns and ``tokens``) the tokens to take:
    ``budget``, ``epochs`` read in full, and the ``rest`` of the last one."""
    table = leaves.withColumns({f"__w{i}": _weight(mix, level) for i, level in enumerate(LEVELS)})
    usable = " * ".join(f"sign(__w{i})" for i in range(len(LEVELS)))
    table = table.withColumn("capacity", F.expr(f"cast(tokens * {mix.max_epochs} * ({usable}) as bigint)"))
    most = f"least(sum(capacity), sum(tokens) * {mix.budget_permille} div 1000)"
    total = table.agg(F.expr(f"cast(coalesce({most}, 0) as bigint)")).first()[0]
    handed = None
    for depth in range(1, len(LEVELS) + 1):
        path, parent = _NODE[:depth], _NODE[: depth - 1]
        nodes = table.groupBy(*path).agg(F.sum("capacity").alias("capacity"), F.first(f"__w{depth - 1}").alias("weight"))
        if handed is None:
            joined = nodes.withColumn("budget", F.lit(total).cast("bigint"))
        else:
            joined = nodes.join(handed.select(*parent, "budget"), parent)
        handed = _share_out(joined, parent, path[-1])
    leaf = table.select(*_NODE, "tokens").join(handed.select(*_NODE, "budget"), _NODE)
    return leaf.select(
        *_NODE,
        "tokens",
        "budget",
        F.expr("if(tokens > 0, budget div tokens, 0)").alias("epochs"),
        F.expr("if(tokens > 0, budget % tokens, 0)").alias("rest"),
    )


def _placed(docs: DataFrame, mix: Mix) -> DataFrame:
    """The rows with their leaf: names as text, null apart from any name."""
    columns = {"domain": f"({mix.domain})", "lang": "lang", "source": "source"}
    return docs.withColumns(
        {f"__node_{level}": F.expr(f"coalesce(concat('=', cast({e} as string)), '')") for level, e in columns.items()}
    )


def _order(mix: Mix) -> Column:
    """A document's place in the last, partly read epoch of its leaf."""
    return F.md5(F.concat_ws("|", F.lit(str(mix.seed)), F.col("__epochs").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def cuts(docs: DataFrame, mix: Mix, tokens: str, folder: str) -> DataFrame:
    """Per leaf the full epochs and where the last one ends: ``__epochs``, and a
    row is read once more if its order is below ``__below``, or at most
    ``__last`` and of the same leading digits."""
    narrow = _placed(docs, mix).select(*_NODE, "doc_id", F.expr(tokens).alias("tokens"))
    narrow = written(narrow, folder, "counted")
    leaves = narrow.groupBy(*_NODE).agg(F.sum("tokens").alias("tokens"))
    plan = written(budgets(leaves, mix), folder, "budgets")
    found = plan.selectExpr(*_NODE, "epochs as __epochs", "rest as __rest", "'' as __below")
    open_rows = narrow.join(found.select(*_NODE, "__epochs"), _NODE).withColumn("__order", _order(mix)).drop("__epochs")
    for step in range(1, _STEPS + 1):
        digits = step * _DIGITS
        inside = open_rows.join(found.select(*_NODE, "__below", "__rest"), _NODE).where("startswith(__order, __below)")
        sums = inside.groupBy(*_NODE, "__rest", F.expr(f"substr(__order, 1, {digits})").alias("__digits")).agg(F.sum("tokens").alias("n"))
        upto = Window.partitionBy(*_NODE).orderBy("__digits").rowsBetween(Window.unboundedPreceding, 0)
        summed = sums.withColumn("__upto", F.sum("n").over(upto)).where("__upto > __rest")
        first = summed.groupBy(*_NODE).agg(F.min(F.struct("__digits", "__upto", "n")).alias("at"))
        # A leaf whose rows all fit has no cut: '~' is above every order.
        found = found.drop("__below").join(first, _NODE, "left").select(
            *_NODE,
            "__epochs",
            F.expr("if(at is null, __rest, __rest - (at.__upto - at.n))").alias("__rest"),
            F.expr("coalesce(at.__digits, '~')").alias("__below"),
        )
        found = written(found, folder, f"cut-{step}")
    last = open_rows.join(found.select(*_NODE, "__below", "__rest"), _NODE).where("startswith(__order, __below)")
    fits = last.withColumn("__upto", F.sum("tokens").over(Window.partitionBy(*_NODE).orderBy("__order"))).where("__upto <= __rest")
    ends = fits.groupBy(*_NODE).agg(F.max("__order").alias("__last"))
    return written(found.drop("__rest").join(ends, _NODE, "left"), folder, "cuts")


def mixed(docs: DataFrame, mix: Mix, tokens: str = TOKENS) -> DataFrame:
    """The rows of ``docs`` to read, all columns, with ``copies``, the number of
    epochs that read them (1 or more).

    Null names of a domain, language or source are a node of their own. Null
    and empty texts have no tokens: they come with every full epoch, and with
    the last one up to its cut. Rows that share a ``doc_id``, null included,
    share their place in the order and are read together or not at all; such
    ties never exceed the budget. An empty table gives no row. A column named
    ``copies``, in any case, is replaced; names starting with ``__`` are refused.
    """
    _, columns = carried(docs, ("copies",))
    folder = new_folder(docs.sparkSession, "mixing")
    # One row per leaf; by its written size it is broadcast or not.
    table = cuts(docs, mix, tokens, folder)
    again = "__order < __below or coalesce(__order <= __last and startswith(__order, __below), false)"
    placed = _placed(docs.select(*columns), mix).join(table, _NODE).withColumn("__order", _order(mix))
    counted = placed.withColumn("copies", F.expr(f"cast(__epochs + if({again}, 1, 0) as int)")).where("copies > 0")
    return counted.select(*columns, "copies")
