"""Connected components by alternating large-star and small-star steps.

Every step is a grouping with a minimum and a join, so a node with very many neighbours is summed
before the shuffle and its join may be split; no list of neighbours is ever built.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

MAX_ROUNDS = 200
#: Edges that a task puts into one file; a round leaves no more edges than it was given.
FILE_ROWS = 100_000


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node to the smallest node around it."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.min("b").alias("_least")).select("a", F.least("a", "_least").alias("_least"))
    return around.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("_least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a node and all its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("_least"))
    moved = down.join(least, "a").filter("b <> _least").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    return moved.unionByName(least.select("a", F.col("_least").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node that has an edge, as (node, component_id).

    `edges` has columns a and b of one type that has an order. Null ends, loops and repeated edges
    are allowed and ignored; an empty table gives an empty result. Rounds go on until nothing
    changes: their number grows with the logarithm of the number of nodes.
    """
    now = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    print_of = lambda d: d.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    seen = print_of(now)
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        now = stage(_small_star(_large_star(now)).coalesce(math.ceil(seen[0] / FILE_ROWS)), "stars")
        new = print_of(now)
        if new == seen:
            break
        seen = new
    else:
        raise RuntimeError(f"components still change after {MAX_ROUNDS} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component_id")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component_id")).unionByName(roots)
