"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.stage import staged

JUMPS = 3


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``): the smallest node of its component.

    Each round hooks every node to its smallest neighbour, shortens the chains of hooks, and replaces
    nodes by what they are hooked to, until no link between different nodes is left. Links shrink at
    least by half a round; every round is written, so it survives lost executors.
    """
    edges = staged(links.select("a", "b").filter("a <> b").distinct(), "links")
    labels = staged(
        edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
        .withColumn("root", F.col("node")),
        "labels",
    )
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        hooks = hooks.select("node", F.least("node", "least").alias("up"))
        for _ in range(JUMPS):
            above = hooks.select(F.col("node").alias("up"), F.col("up").alias("further"))
            hooks = hooks.join(above, "up", "left").select("node", F.coalesce("further", "up").alias("up"))
        hooks = staged(hooks, "hooks")

        def lifted(frame: DataFrame, column: str, by: DataFrame = hooks) -> DataFrame:
            others = [c for c in frame.columns if c != column]
            return frame.join(by.withColumnRenamed("node", column), column, "left").select(
                *others, F.coalesce("up", column).alias(column)
            )

        labels = staged(lifted(labels, "root"), "labels")
        moved = lifted(lifted(edges, "a"), "b").filter("a <> b")
        edges = staged(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    return labels
