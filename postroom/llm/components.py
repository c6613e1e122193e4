"""Connected components by least labels, over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least node that each node of ``edges`` (a, b) is linked to.

    Each round takes the least label among the neighbours and then the label's
    own label, so the rounds grow with the logarithm of the longest path. Labels
    are written each round; only a count comes to the driver.
    """
    both = edges.where("a <> b").select("a", "b")
    both = written(both.unionByName(both.selectExpr("b AS a", "a AS b")).distinct(), "edges")
    labels = both.groupBy("a").agg(F.min("b").alias("near"))
    labels = written(labels.select(F.col("a").alias("node"), F.least("a", "near").alias("root")), "labels")
    while True:
        at_b = labels.select(F.col("node").alias("b"), F.col("root").alias("seen"))
        seen = both.join(at_b, "b").groupBy("a").agg(F.min("seen").alias("seen"))
        lower = labels.join(seen.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("root").alias("was"), F.least("root", "seen").alias("root")
        )
        jump = lower.select(F.col("node").alias("root"), F.col("root").alias("next"))
        after = lower.join(jump, "root", "left").select(
            "node", "was", F.least("root", F.coalesce("next", "root")).alias("root")
        )
        after = written(after, "labels")
        changed = after.where("was <> root").limit(1).count()
        labels = after.select("node", "root")
        if not changed:
            return labels


def star_components(stars: DataFrame) -> DataFrame:
    """node, root for ``stars`` (node, leader): many nodes that share few leaders.

    A node stands with its least leader, and that one is linked to its other
    leaders; a large group then has one row per node and few distinct pairs of
    leaders. Rounds run over the leaders only, and the nodes are read off once.
    """
    least = F.min("leader").over(Window.partitionBy("node"))
    near = written(stars.select("node", "leader", least.alias("near")).distinct(), "stars")
    nodes = near.where("leader = near").select("node", "near")
    leaders = near.select(F.col("leader").alias("node")).distinct()
    pairs = near.where("leader <> near").selectExpr("leader AS a", "near AS b").distinct()
    # A leader that is itself a node of others ties both sides together.
    own = nodes.join(leaders, "node", "left_semi").selectExpr("node AS a", "near AS b")
    roots = components(pairs.unionByName(own))
    roots = roots.withColumnsRenamed({"node": "near", "root": "found"})
    alone = leaders.join(nodes, "node", "left_anti").withColumn("near", F.col("node"))
    return (
        nodes.unionByName(alone)
        .join(roots, "near", "left")
        .select("node", F.coalesce("found", "near").alias("root"))
    )
