"""Connected components of an edge table, by contraction towards smaller nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an undirected edge table whose root is not itself.

    Each round keeps, for every node, the edge to its smallest lower neighbour and hands its other
    lower neighbours on to that one: edges move strictly down and never grow in number.  When every
    node has one lower neighbour left, the edges form trees, and roots follow by doubling.  Null ends
    and loops are ignored; an empty table has no rows.
    """
    left = materialize(edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi > lo").distinct(), "edges")
    while True:
        parents = materialize(left.groupBy("hi").agg(F.min("lo").alias("up"), F.count("*").alias("n")), "parents")
        if parents.where("n > 1").isEmpty():
            break
        moved = left.join(parents.where("n > 1"), "hi").where("lo <> up").select(F.col("lo").alias("x"), F.col("up").alias("y"))
        kept = parents.select(F.col("hi").alias("x"), F.col("up").alias("y"))
        left = materialize(kept.unionByName(moved).select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo")).distinct(), "edges")
    trees = parents.select("hi", "up")
    while True:
        above = trees.select(F.col("hi").alias("up"), F.col("up").alias("top"))
        trees = materialize(trees.join(above, "up", "left").select("hi", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")), "trees")
        if trees.where("moved").isEmpty():
            return trees.select(F.col("hi").alias("node"), F.col("up").alias("root"))
        trees = trees.select("hi", "up")
