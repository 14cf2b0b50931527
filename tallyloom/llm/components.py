"""Connected components by smallest label, with pointer jumping, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import materialise


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (smallest reachable node) for every node of the undirected edges.

    Each round takes the smallest label among the neighbours and then the label of that label,
    so a star ends after one round and a chain after a logarithmic number. Labels are stored
    every round; joins are on stored tables, so a hub's rows can be split. Loops and repeated
    edges do no harm, edges with a null end are left out.
    """
    some = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).dropna()
    both = some.union(some.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pairs = materialise(both.distinct(), "edges")
    labels = materialise(pairs.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        near = (
            pairs.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        better = materialise(
            labels.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("was")),
            "labels",
        )
        to = better.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = materialise(
            better.join(to, "label").select("node", F.col("next").alias("label"), (F.col("next") != F.col("was")).alias("changed")),
            "labels",
        )
        if not new.filter("changed").limit(1).count():
            return new.select("node", F.col("label").alias("component"))
        labels = new.drop("changed")
