"""Connected components of a large graph by minimum labels with shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cvelake.session import stage


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) as (node, label): the smallest node of each node's component.

    Each round a node takes the smallest label of itself and its neighbours, then
    the label of that label, so rounds grow with the logarithm of a component's
    diameter. Rounds are written tables: joins run on plain exchanges, whose hot
    keys (the centre of a star) Spark splits, and minima are pre-aggregated. Nothing
    but a count comes to the driver."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b")
    both = stage(both, "edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        told = both.join(labels, F.col("a") == F.col("node")).select(F.col("b").alias("node"), "label", F.lit(None).cast("long").alias("before"))
        least = labels.select("node", "label", F.col("label").alias("before")).union(told)
        least = stage(least.groupBy("node").agg(F.min("label").alias("label"), F.max("before").alias("before")), "labels")
        of_label = least.select(F.col("node").alias("label"), F.col("label").alias("further"))
        further = stage(least.join(of_label, "label").select("node", F.least("label", "further").alias("label"), "before"), "labels")
        labels = further.select("node", "label")
        if further.filter("label < before").isEmpty():
            return labels
