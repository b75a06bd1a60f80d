"""Connected components of a link table, without leaving Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from difframe.runtime import staged, unstage


def connected_components(nodes: DataFrame, links: DataFrame, node: str = "node") -> DataFrame:
    """``node, component``: the smallest node reachable by ``links(a, b)``.

    Smallest labels spread along links, and every round also jumps to the label of the label, so rounds grow with the
    logarithm of a chain's length.  Each round is written to the shared folder and replaces the one before; only one count reaches the driver.
    """
    both = staged(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    before = labels = staged(nodes.select(F.col(node).alias("n"), F.col(node).alias("c")).distinct(), "labels")
    while True:
        near = both.join(labels.select(F.col("n").alias("b"), "c"), "b").groupBy(F.col("a").alias("n")).agg(F.min("c").alias("m"))
        spread = labels.join(near, "n", "left").select("n", "c", F.least("c", F.coalesce("m", "c")).alias("m"))
        jump = spread.join(labels.select(F.col("n").alias("m"), F.col("c").alias("j")), "m", "left")
        step = staged(jump.select("n", F.col("c").alias("old"), F.least("m", F.coalesce("j", "m")).alias("c")), "labels")
        unstage(before)
        before, labels = step, step.select("n", "c")
        if step.where("old <> c").isEmpty():
            unstage(both)
            return labels.select(F.col("n").alias(node), F.col("c").alias("component"))
