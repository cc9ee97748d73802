"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keytide.llm.common import cut


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``; the root is the least node reachable.

    Alternates the large-star and small-star steps of Kiveris et al. until every
    edge points from a node to its root.  A hub's neighbours are only ever
    combined by a minimum and joined, never gathered.
    """
    stars = cut(edges.selectExpr("greatest(a, b) as a", "least(a, b) as b").where("a <> b").distinct())
    before = None
    for _ in range(rounds):
        both = stars.unionAll(stars.selectExpr("b as a", "a as b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").selectExpr("b as a", "m as b")
        # Every edge now runs from a node to a smaller one, so a node's edges are its smaller neighbours.
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").selectExpr("b as a", "m as b").unionAll(least.selectExpr("a", "m as b"))
        stars = cut(small.where("a <> b").distinct())
        state = stars.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components: no fixed point within the given rounds")
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
