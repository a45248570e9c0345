"""Connected components by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.skewed import join_heavy
from tallyspan.llm.staging import staged


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its least node) of all nodes in ``edges`` (``a, b``, both directions implied).

    Each round takes the least label among the neighbours and then the label of that label, so the number
    of rounds grows with the logarithm of a component's width. Labels are written after each round.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = staged(both.where("a <> b").distinct(), "edges")
    total = both.count()
    first = both.groupBy("a").agg(F.min("b").alias("b"), F.count(F.lit(1)).alias("degree"))
    labels = staged(first.select(F.col("a").alias("node"), F.least("a", "b").alias("component"), "degree"), "labels")
    while True:
        # the centre of a star is the neighbour of many nodes
        ends = labels.select(F.col("node").alias("b"), F.col("component").alias("near"), "degree")
        near = join_heavy(both, ends, ["b"], "degree", total).groupBy("a").agg(F.min("near").alias("near"))
        met = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", "degree", "component", F.least("component", "near").alias("least")
        )
        jump = labels.select(F.col("node").alias("least"), F.col("component").alias("further"))
        new = met.join(jump, "least").select("node", "degree", F.least("least", "further").alias("new"), "component")
        new = staged(new, "labels")
        if new.where("new <> component").isEmpty():
            return labels.drop("degree")
        labels = new.select("node", F.col("new").alias("component"), "degree")
