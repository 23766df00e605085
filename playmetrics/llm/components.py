"""Connected components by alternating large and small stars.

Every round is a pair of group-wise minima, which combine on the map side, and joins of edges with those
by node, in which a node with very many edges is split. So no component meets in one task, nor does a
star around its centre. The number of rounds grows with the logarithm of the longest path. Each half
of a round is stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmetrics.operators.skew import spread_join
from playmetrics.storage import store


def _oriented(edges: DataFrame) -> DataFrame:
    """Edges without direction, loops or copies; ``a`` is the larger end."""
    return (
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where(F.col("a") != F.col("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours.

    ``edges`` is read several times, and so is that of ``_small_star``.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    return (
        spread_join(both.where(F.col("b") > F.col("a")), least, "a")
        .select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = spread_join(edges, least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b")))


def _signature(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed)).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for every node of an edge.

    ``edges`` has columns ``a`` and ``b`` of one orderable type. Calling this runs jobs.
    """
    current = store(_oriented(edges))
    seen = _signature(current)
    while True:
        current = store(_oriented(_small_star(store(_oriented(_large_star(current))))))
        now = _signature(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return roots.unionByName(current.select(F.col("a").alias("node"), F.col("b").alias("root")))
