"""Connected components of an undirected graph given as an edge table.

Alternating large-star / small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond"): every round rewires each node's
neighbours to the smallest node it can see, so the graph shrinks to stars in
few rounds whatever the shape of the components.  Each round is two
aggregations and joins over the edge table; the table is written to the
checkpoint folder once per round to cut lineage.  Only a changed-edge count
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    ends = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    return edges.select(F.explode(ends).alias("e")).select("e.*")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest of itself and its neighbours."""
    near = _both_ways(edges)
    low = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return near.where(F.col("v") > F.col("u")).join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    low = edges.groupBy("b").agg(F.min("a").alias("m"))
    linked = edges.join(low, "b")
    return linked.select(F.explode(F.array("a", "b")).alias("x"), "m").where(F.col("x") != F.col("m")).select(F.col("m").alias("a"), F.col("x").alias("b"))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): root is the smallest node reachable.  Nodes that have no
    edge are absent; self-edges and repeated edges count for nothing; ends must
    not be null.  No edges give an empty table."""
    pairs = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()
    current = materialize(pairs)
    while True:
        step = materialize(_small_star(_large_star(current).distinct()).distinct())
        # Both tables hold distinct edges: equal counts and no new edge mean the same edges.
        if step.count() == current.count() and step.join(current, ["a", "b"], "left_anti").isEmpty():
            return step.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                step.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
            )
        current = step
