"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairdraw.llm.storage import written


# A vertex with more than one part in so many of the edges is a large one.
PARTS = 1000


def _with_least(edges: DataFrame, least: DataFrame, limit: int) -> DataFrame:
    """Edges with the ``m`` of their ``a``. Large vertices, of which there are
    ``2 * PARTS`` at most, are looked up in a broadcast table; their edges are dealt
    out by ``b``, so the shuffled join never brings more than ``limit`` edges of a
    vertex, and ``2 * PARTS`` of a ``b``, together. What ``b`` finds is not used."""
    large = F.broadcast(least.where(f"n > {limit}").selectExpr("a", "m as m_large"))
    small = least.where(f"n <= {limit}").selectExpr("a as vertex", "m as m_small")
    found = edges.join(large, "a", "left").join(small, F.expr("vertex = if(m_large is null, a, b)"), "left")
    return found.select("a", "b", F.coalesce("m_large", "m_small").alias("m"))


def _large_star(edges: DataFrame, limit: int) -> DataFrame:
    """Tie every larger neighbour of a vertex to its smallest neighbour."""
    both = edges.select("a", "b").union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count(F.lit(1)).alias("n"))
    return _with_least(both.where("b > a"), least, limit).selectExpr("b as a", "m as b").distinct()


def _small_star(edges: DataFrame, limit: int) -> DataFrame:
    """Tie a vertex and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
    # Every vertex has an edge to its smallest neighbour: that ties the vertex itself.
    moved = _with_least(edges, least, limit).selectExpr("if(b = m, a, b) as a", "m as b")
    return moved.distinct()


def _stars_and_size(edges: DataFrame) -> tuple[bool, int]:
    """Whether every vertex with a smaller neighbour has one only and is nobody's
    smaller neighbour, and the number of edges."""
    ends = edges.selectExpr("stack(2, a, 1, b, 0) as (vertex, above)")
    seen = ends.groupBy("vertex").agg(F.sum("above").alias("up"), F.min("above").alias("lowest"))
    chained = F.expr("count_if(up > 1 or up = 1 and lowest = 0)")
    found = seen.agg(chained.alias("chained"), F.sum("up").alias("size")).first()
    return not found["chained"], found["size"] or 0


def components(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """``id, component`` of every vertex that is not the smallest of its
    component. ``edges`` has two columns of vertices; direction, repetition and
    loops don't matter, edges with a null are none.

    Alternates large-star and small-star steps until the edges are stars: a
    number of rounds that grows with the logarithm of the vertices. Smallest
    neighbours are combined before each shuffle, and edges of large vertices are
    not dealt out by them to be joined, so a vertex may have any number of edges.
    Every round is written, so lineage stays short.
    """
    a, b = edges.columns
    edges = edges.where(f"{a} <> {b}").selectExpr(f"greatest({a}, {b}) as a", f"least({a}, {b}) as b")
    edges, number = written(edges.distinct(), folder, f"{name}-0"), 0
    while True:
        stars, size = _stars_and_size(edges)
        if stars:
            return edges.selectExpr("a as id", "b as component")
        number += 1
        limit = max(2, size // PARTS)
        large = written(_large_star(edges, limit), folder, f"{name}-{number}-large")
        edges = written(_small_star(large, limit), folder, f"{name}-{number}")
