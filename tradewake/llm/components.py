"""Connected components of a graph whose links are a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.session import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b); label is the smallest node reachable.

    Every round takes the smallest label among the neighbours and then the label of that label,
    which halves long chains. Each round is a table in the shared folder, so neither the lineage
    nor the driver's memory grows; the driver sees only whether anything changed.
    """
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both.filter("a <> b").distinct(), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
                    .select("node", F.least("node", "b").alias("label")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "label"), "b") \
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        moved = labels.join(near, "node").select(
            "node", F.col("label").alias("before"), F.least("label", "near").alias("step"))
        target = labels.select(F.col("node").alias("step"), F.col("label").alias("jump"))
        labels = stored(moved.join(target, "step", "left").select(
            "node", F.least("step", "jump").alias("label"), "before"), "labels")
        if labels.filter("label <> before").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
