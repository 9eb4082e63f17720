"""Connected components of an edge list by alternating large-star and small-star steps
(Kiveris et al., 2014). Every step is a group minimum and a join, and each round is cut to the
shared checkpoint folder, so a lost executor costs at most one round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node that an edge names; label is the component's smallest node."""
    e = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
            .where("u != v").distinct())
    seen = _print(e)
    while True:
        # large star: every larger neighbour of u goes to the smallest of u and its neighbours
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large)
        # small star: u and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        e = cut(large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .union(least.select("u", F.col("m").alias("v"))).distinct())
        now = _print(e)
        if now == seen:
            break
        seen = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("label"))
            .union(e.select("v", "v").distinct()))
