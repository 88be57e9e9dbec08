"""Connected components of an edge table by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import joined, written

#: Edges that a partition holds when a round begins: a round over few edges is not spread over all partitions of the session.
EDGES = 100_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is tied to the smallest of u and its neighbours."""
    both = edges.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    return joined(both, least, ["a"]).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    tied = F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))
    return joined(down, least, ["a"]).select(F.inline(tied)).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b; self-loops and repeats
    allowed); component is the smallest node reachable.

    Groups are only ever reduced to their minimum, never collected, and the edges of a hub are
    told its minimum by broadcast, so that no task has all of them. Each round is a table in the shared folder. A round that changes
    nothing (the same number and checksum of edges) ends the work; there is no limit on rounds,
    whose number grows with the logarithm of the longest chain, squared at most.
    """
    def state() -> tuple[int, int]:
        return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges = written(edges.where("a <> b").select("a", "b").distinct())
    before, now = None, state()
    while now != before:
        edges = written(_small_star(_large_star(edges.coalesce(1 + now[0] // EDGES))))
        before, now = now, state()
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
