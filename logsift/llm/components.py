"""Connected components of an edge table by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logsift.llm.common import RUNS, checkpoint, spread_join


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b); root: the smallest node reachable.

    Each round a node hooks itself and its parent to the smallest grandparent
    among its neighbours and jumps to its own grandparent, so that paths halve:
    the rounds grow with the logarithm of the longest path.  A root that many nodes
    share is met salted, so that no task gets all its children.  Only aggregates of
    (node, parent) rows are kept; each round is cut by a reliable checkpoint.
    """
    both = checkpoint(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    up = checkpoint(both.groupBy(F.col("a").alias("node"))
                    .agg(F.least(F.first("a"), F.min("b")).alias("parent")))
    while True:
        over = up.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        salted = up.withColumn("_run", F.pmod(F.xxhash64("node"), F.lit(RUNS)).cast("int"))
        grand = checkpoint(spread_join(salted, over, ["parent"]).select("node", "parent", "grand"))
        near = (both.join(grand.select(F.col("node").alias("b"), "grand"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("grand").alias("low")))
        seen = grand.join(near, "node")
        offers = seen.select(F.explode(F.array(
            F.struct(F.col("node"), F.least("parent", "grand", "low").alias("parent")),
            F.struct(F.col("parent").alias("node"), F.col("low").alias("parent")))).alias("o")).select("o.*")
        new = offers.groupBy("node").agg(F.min("parent").alias("parent"))
        new = checkpoint(new.join(up.select("node", F.col("parent").alias("was")), "node")
                         .select("node", F.least("parent", "was").alias("parent"),
                                 (F.least("parent", "was") < F.col("was")).alias("moved")))
        if not new.where("moved").take(1):
            return new.select("node", F.col("parent").alias("root"))
        up = new.select("node", "parent")
