"""Connected components of an edge table, as joins and aggregates on tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common as C


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b): the label is the least node that can be reached.

    Every round takes the least label of a node's neighbours and then the label of that label, so that the rounds
    grow with the logarithm of the longest chain. Nothing but a count comes to the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    both = C.stored(both, "edges")
    labels = C.stored(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        better = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = better.select(F.col("node").alias("label"), F.col("label").alias("far"))
        new = C.stored(better.join(jump, "label").select("node", "old", F.least("label", "far").alias("label")), "labels")
        if new.filter("label <> old").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")


def joined(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """The components of a graph of which ``labels`` tells those of its other edges.

    A component that is known takes part as one node, its label, so that edges are walked once and not again with all
    that follow.
    """
    named = edges.select("a", "b")
    for end in ("a", "b"):
        named = named.join(labels.select(F.col("node").alias(end), F.col("label").alias("label")), end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
    moved = components(named)
    known = labels.join(moved.select(F.col("node").alias("label"), F.col("label").alias("far")), "label", "left").select("node", F.coalesce("far", "label").alias("label"))
    return C.stored(known.union(moved.join(labels.select("node"), "node", "left_anti").select("node", "label")), "labels")
