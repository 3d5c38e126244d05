"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gathered, stored


def connected_components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """``id, component`` for every id in ``edges(a, b)``, the component's least id.

    Alternates two steps until the edges stay the same: every vertex links its larger
    neighbours to the least vertex it knows, then every vertex links its smaller
    neighbours to it.  Each step keeps the components and shortens paths, so the number
    of rounds grows with the logarithm of the longest path.  Least neighbours are
    aggregates, combined before the shuffle; the edges of a vertex with many of them are
    joined to the one row of its least neighbour and never gathered.  Edges are written
    to the shared folder after each round, in as many files as they fill; ``most`` is
    about the largest number of edges there may be, if known.
    """
    now = edges.select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).where("u > v")
    now = now.distinct()
    now = stored(now if most is None else gathered(now, most), "edges")
    before = None
    while True:
        mark = now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if mark == before or not mark[0]:
            break
        before = mark
        now = stored(gathered(_small_star(_large_star(now)), mark[0]), "edges")
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        roots.distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each vertex move to the least vertex in its neighbourhood."""
    both = edges.union(edges.select("v", "u")).toDF("x", "y")
    least = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
    moved = both.where("y > x").join(least, "x")
    return moved.select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each vertex, and the vertex, move to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.where("u > v").union(own).distinct()
