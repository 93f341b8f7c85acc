"""Connected components by alternating large and small stars, on written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from derrick.session import cut_lineage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of the long pairs ``(a, b)``.

    Each round joins edges to the smallest neighbour of their node, which partial
    aggregation finds first; a hub's edges are many rows of a join, never one group.
    Rounds grow with the logarithm of the longest chain.
    """
    one = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    stars = cut_lineage(one)
    state = _state(stars)
    while state[0]:
        both = stars.unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = cut_lineage(small.unionAll(lower.select("u", F.col("m").alias("v"))).distinct())
        last, state = state, _state(stars)
        if last == state:
            break
    roots = stars.select(F.col("v").alias("node")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots.select("node", F.col("node").alias("component")))
