"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a partial/final minimum per node and one join; nothing but two
numbers per round (edge count and checksum) reaches the driver. The edge table
is written to the shared folder after each round, so lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import materialise


def large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node to the smallest of its neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Connect the smaller neighbours of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u != v").distinct()


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node of its component."""
    spark = edges.sparkSession
    state = materialise(spark, edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v"), "edges")
    seen = None
    for _ in range(max_rounds):
        check = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if check == seen or check[0] == 0:
            break
        seen = check
        state = materialise(spark, small_star(large_star(state)), "edges")
    else:
        raise RuntimeError("components did not converge")
    roots = state.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
