"""Near-duplicate embeddings by an epsilon grid order join.

Vectors are scaled to length 1, so a cosine of at least ``COSINE`` is a distance
of at most ``EPS``. They are projected on their leading principal directions,
which never lengthens a distance, and sorted by the cells of a grid of width
``EPS`` there. The sorted sequence is cut into blocks of ``BLOCK`` vectors.

Intervals of the sequence form a tree: a block, ``FAN`` blocks, ``FAN`` times
as many, and so on, each with its bounding box in the projection. The join
starts with the whole sequence against itself and goes down level by level;
a pair of intervals whose boxes are further apart than ``EPS`` is dropped with
all that is below it. Each level is an ordinary equi-join of the pairs with the
intervals' children. The pairs of blocks that remain are compared as matrices in
double precision. A task returns per vector the number of its links in this pair
of blocks and one vector of its connected group there, so neither the links nor
the pairs of a dense group are ever listed.

Equal vectors are one node with a count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairdraw.llm.components import components
from fairdraw.llm.storage import new_folder, written

COSINE = 0.9
# A little more than the distance, for rounding in the projection.
EPS = float(np.sqrt(2 - 2 * COSINE)) + 1e-9
DIRECTIONS, BLOCK, FAN = 8, 2048, 16

_LOW = [f"low{i}" for i in range(DIRECTIONS)]
_HIGH = [f"high{i}" for i in range(DIRECTIONS)]


def keyed(rows: DataFrame) -> DataFrame:
    """``vec_id, key, size, embedding``: equal vectors share a key; vectors that
    link with nothing have none. ``size`` is the number of components, which stay
    floats if they are and are doubles otherwise."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes = [], []
            for vector in batch.column("embedding"):
                values = vector.values if vector.is_valid else None
                table = None if values is None or values.null_count else np.asarray(values, np.float64)
                usable = table is not None and bool(np.isfinite(table).all()) and bool(table.any())
                data = table.tobytes() if usable else b""
                keys.append(int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True) if usable else None)
                sizes.append(len(table) if usable else 0)
            columns = [batch.column("vec_id"), pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()), batch.column("embedding")]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "key", "size", "embedding"])

    kind = "array<float>" if dict(rows.dtypes)["embedding"] == "array<float>" else "array<double>"
    narrow = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast(kind))
    return narrow.mapInArrow(run, f"vec_id long, key long, size int, embedding {kind}")


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """The vectors of a column in rows, scaled to length 1."""
    table = np.asarray(column.flatten(), np.float64).reshape(-1, size)
    # By powers of two, which round nothing, so that no square leaves the range of doubles.
    table = np.ldexp(table, -np.frexp(np.abs(table).max(axis=1, keepdims=True))[1])
    return table / np.linalg.norm(table, axis=1, keepdims=True)


def _directions(nodes: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and leading principal directions. Tasks add up moments, so
    ``size * (size + 1)`` numbers are shuffled per task and collected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = 0, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            table = _matrix(batch.column("embedding"), size)
            n, total, products = n + len(table), total + table.sum(0), products + table.T @ table
        values = np.concatenate(([n], total, products.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], ["at", "value"])

    sums = nodes.select("embedding").mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    values = np.zeros(1 + size + size * size)
    for row in sums.collect():
        values[row["at"]] = row["value"]
    n, mean = max(values[0], 1), values[1 : size + 1] / max(values[0], 1)
    spread = values[size + 1 :].reshape(size, size) / n - np.outer(mean, mean)
    return mean, np.linalg.eigh(spread)[1][:, ::-1][:, :DIRECTIONS]


def _sequenced(nodes: DataFrame, size: int, folder: str) -> DataFrame:
    """The nodes with their block in the grid order."""
    mean, directions = _directions(nodes, size)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = (_matrix(batch.column("embedding"), size) - mean) @ directions
            places = np.pad(places, ((0, 0), (0, DIRECTIONS - places.shape[1])))
            cells = np.floor(places / EPS).astype(np.int32)
            offsets = pa.array(np.arange(len(places) + 1, dtype=np.int32) * DIRECTIONS)
            columns = [pa.ListArray.from_arrays(offsets, pa.array(x.ravel())) for x in (places, cells)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("n"), batch.column("embedding"), *columns], ["key", "n", "embedding", "places", "cells"]
            )

    kind = f"key long, n long, embedding {dict(nodes.dtypes)['embedding']}, places array<double>, cells array<int>"
    placed = written(nodes.select("key", "n", "embedding").mapInArrow(project, kind), folder, "placed", rows=4096)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            n = batch.num_rows
            extra = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "part", "at"])
            at += n

    # The key as a second criterion splits a cell that many vectors share.
    partitions = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(partitions, "cells", "key").sortWithinPartitions("cells", "key")
    numbered = written(ordered.mapInArrow(number, f"{kind}, part int, at long"), folder, "numbered", rows=4096)
    # One row per partition.
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    offsets = counts.select("part", F.coalesce(F.sum("rows").over(upto), F.lit(0)).alias("before"))
    return numbered.join(F.broadcast(offsets), "part").select(
        "key", "n", "embedding", "places", F.expr(f"(before + at) div {BLOCK}").alias("block")
    )


def _near_blocks(sequenced: DataFrame, folder: str) -> DataFrame:
    """Pairs of blocks ``a <= b`` whose boxes are at most ``EPS`` apart."""
    bounds = [f(F.col("places")[i]).alias(name) for f, names in ((F.min, _LOW), (F.max, _HIGH)) for i, name in enumerate(names)]
    level = written(sequenced.groupBy("block").agg(*bounds), folder, "boxes-0")
    levels = [level]
    while level.count() > 1:
        parents = level.groupBy(F.expr(f"block div {FAN}").alias("block")).agg(
            *[F.min(c).alias(c) for c in _LOW], *[F.max(c).alias(c) for c in _HIGH]
        )
        level = written(parents, folder, f"boxes-{len(levels)}")
        levels.append(level)
    gaps = [f"pow(greatest(0, a_{low} - b_{high}, b_{low} - a_{high}), 2)" for low, high in zip(_LOW, _HIGH, strict=True)]
    near = f"a <= b and {' + '.join(gaps)} <= {EPS * EPS + 1e-9}"
    pairs = levels[-1].selectExpr("block as a", "block as b")
    for depth in range(len(levels) - 2, -1, -1):
        sides = [
            levels[depth].select(
                F.col("block").alias(side), F.expr(f"block div {FAN}").alias(f"up_{side}"), *[F.col(c).alias(f"{side}_{c}") for c in (*_LOW, *_HIGH)]
            )
            for side in "ab"
        ]
        above = pairs.selectExpr("a as up_a", "b as up_b")
        # Within one interval both orders of a pair of children are made, one kept.
        pairs = above.join(sides[0], "up_a").join(sides[1], "up_b").where(near).select("a", "b")
        pairs = written(pairs, folder, f"pairs-{depth}")
    return pairs


def _grouped(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Connected groups of a table of links between two sides: per row and per
    column the smallest row of its group."""
    m = linked.shape[0]
    rows = np.arange(m)
    while True:
        columns = np.where(linked, rows[:, None], m).min(axis=0, initial=m)
        new = np.minimum(rows, np.where(linked, columns[None], m).min(axis=1, initial=m))
        new = new[new]
        if (new == rows).all():
            return rows, columns
        rows = new


def _links(sequenced: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """Per pair of blocks and linked node: the vectors it is linked with there,
    and a node of its group there."""
    blocks = sequenced.groupBy("block").agg(F.collect_list(F.struct("key", "n", "embedding")).alias("entries"))
    joined = pairs.join(blocks.selectExpr("block as a", "entries as entries_a"), "a").join(
        blocks.selectExpr("block as b", "entries as entries_b"), "b"
    )

    def side(entries: pa.ListScalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = entries.values
        return np.asarray(found.field("key")), np.asarray(found.field("n")), _matrix(found.field("embedding"), size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, left, right in zip(*[batch.column(c) for c in ("a", "b", "entries_a", "entries_b")], strict=True):
                same = a.as_py() == b.as_py()
                keys_a, n_a, table_a = side(left)
                keys_b, n_b, table_b = (keys_a, n_a, table_a) if same else side(right)
                linked = table_a @ table_b.T >= COSINE
                if same:
                    np.fill_diagonal(linked, False)
                row, column = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
                linked = linked[np.ix_(row, column)]
                if not len(row):
                    continue
                groups, of_columns = _grouped(linked)
                root = keys_a[row]
                nodes, others, counts = [keys_a[row]], [root[groups]], [linked @ n_b[column]]
                if not same:
                    nodes, others = [*nodes, keys_b[column]], [*others, root[of_columns]]
                    counts.append(linked.T @ n_a[row])
                else:
                    # Links within a block tie both of their ends to the group.
                    nodes, others = [*nodes, keys_b[column]], [*others, root[of_columns]]
                    counts.append(np.zeros(len(column), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.int64)) for x in (nodes, others, counts)], ["key", "other", "links"]
                )

    work = joined.select("a", "b", "entries_a", "entries_b")
    return work.mapInArrow(run, "key long, other long, links long")


def near_duplicates(rows: DataFrame) -> DataFrame:
    """Per row of ``rows`` (``vec_id, embedding``): ``vec_id, n_links,
    component_id, kept``.

    Vectors are linked at a cosine of at least ``COSINE`` in double precision,
    of components as the column holds them;
    ``component_id`` is the smallest ``vec_id`` reachable by links. Null, empty
    and zero vectors and those with null or non-finite components link with
    nothing, nor do vectors of different size. Rows that repeat a ``vec_id``
    are vectors of their own. A null ``vec_id`` takes part but names no
    component: only a component without any other id has a null one. An empty
    table gives no row. Other columns are not read.
    """
    spark = rows.sparkSession
    folder = new_folder(spark, "vectors")
    parsed = written(keyed(rows), folder, "parsed", rows=4096)
    nodes = parsed.where("key is not null").groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.first("size").alias("size"), F.first("embedding").alias("embedding")
    )
    nodes = written(nodes, folder, "nodes")
    found = None
    # One round per vector size; a column of embeddings has one.
    for size in sorted(r["size"] for r in nodes.select("size").distinct().collect()):
        base = f"{folder}/{size}"
        sequenced = written(_sequenced(nodes.where(F.col("size") == size), size, base), base, "sequenced")
        links = written(_links(sequenced, _near_blocks(sequenced, base), size), base, "links", rows=4)
        found = links if found is None else found.unionByName(links)
    if found is None:
        return parsed.selectExpr("vec_id", "0L as n_links", "vec_id as component_id", "true as kept")
    joined = components(found.select("key", "other"), folder, "joined").withColumnRenamed("id", "key")
    counted = found.groupBy("key").agg(F.sum("links").alias("links"))
    labels = (
        nodes.select("key", "n")
        .join(counted, "key", "left")
        .join(joined, "key", "left")
        .select("key", F.expr("n - 1 + coalesce(links, 0)").alias("n_links"), F.expr("coalesce(component, key)").alias("label"))
    )
    placed = written(parsed.select("vec_id", "key").join(labels, "key", "left"), folder, "labelled")
    smallest = placed.where("label is not null").groupBy("label").agg(F.min("vec_id").alias("smallest"))
    return placed.join(smallest, "label", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.expr("if(label is null, vec_id, smallest)").alias("component_id"),
        F.expr("label is null or vec_id <=> smallest").alias("kept"),
    )
