"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.session import stage


def _state(edges: DataFrame) -> tuple:
    """Number and order-free checksum of the edges, to see whether a round changed anything."""
    row = edges.select(F.xxhash64("u", "v").alias("h")).agg(F.count("h"), F.sum(F.col("h").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """(u, root) for every node u of ``edges`` (u > v, long) but the smallest of its component, root.

    Alternates stars over larger and smaller neighbours until nothing changes, which takes about
    log n rounds; every round is staged, so lost executors cost no more than a round. A hub only
    meets its neighbours in a minimum and a join, never in one group. Nulls must not occur.
    """
    current = stage(edges.select("u", "v").where("u > v").distinct(), "edges")
    before = _state(current)
    for _ in range(rounds):
        if not before[0]:
            break
        current = stage(_small(_large(current).distinct()).where("u != v").distinct(), "edges")
        after = _state(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return current.select("u", F.col("v").alias("root"))
