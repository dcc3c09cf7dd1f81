"""Connected components of a table of links, by contraction: every root that has a link to a
smaller root hangs itself below the smallest, the trees are flattened by pointer jumping, and links
between what are now equal roots go. All steps are joins and aggregates of (node, root) pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsieve.llm.base import written


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node that each node of ``links`` (a, b) is connected with."""
    nodes = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    labels = written(nodes.withColumn("root", F.col("node")), "labels")
    open_links = written(links.select("a", "b").where("a <> b").distinct(), "links")
    while not open_links.isEmpty():
        parents = written(
            open_links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
            .groupBy("node")
            .agg(F.min("root").alias("root")),
            "parents",
        )
        while True:
            up = parents.select(F.col("node").alias("root"), F.col("root").alias("above"))
            if parents.join(up, "root", "left_semi").isEmpty():
                break
            parents = written(
                parents.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root")), "parents"
            )
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("above"))
        labels = written(
            labels.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root")), "labels"
        )
        for side in ("a", "b"):
            above = parents.select(F.col("node").alias(side), "root")
            open_links = open_links.join(above, side, "left").withColumn(side, F.coalesce("root", side)).drop("root")
        open_links = written(open_links.where("a <> b").distinct(), "links")
    return labels
