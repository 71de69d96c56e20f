"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propval.llm.store import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of links (a, b): the smallest node it
    reaches.  Each round takes the smallest label among the neighbours, then
    the label of the label, so long chains shrink by doubling; the table of
    labels is written after each round."""
    edges = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")))
    while True:
        near = (edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        lower = labels.join(near, "node", "left").select("node", F.col("component").alias("was"), F.least("component", "near").alias("c"))
        jump = labels.select(F.col("node").alias("c"), F.col("component").alias("jump"))
        step = written(lower.join(jump, "c", "left").select("node", "was", F.least("c", "jump").alias("component")))
        labels = step.select("node", "component")
        if step.where("component <> was").isEmpty():
            return labels
