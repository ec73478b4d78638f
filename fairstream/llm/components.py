"""Connected components of a graph that is a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairstream.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, comp`` of all nodes in ``edges(a, b)``; comp is the component's smallest node.

    Every round gives a node the smallest label around it and then its label's label. Labels are
    tables in the shared folder, edges join them by key, and minima are combined before they are
    shuffled, so a node with very many edges is no large group.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node"))
                    .agg(F.least(F.col("a"), F.min("b")).alias("comp")), "labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("b"), "comp"), "b") \
            .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("around"))
        lower = labels.join(around, "node").select(
            "node", F.col("comp").alias("before"), F.least("comp", "around").alias("comp"))
        above = labels.select(F.col("node").alias("comp"), F.col("comp").alias("above"))
        after = stored(lower.join(above, "comp").select(
            "node", "before", F.least("comp", "above").alias("comp")), "labels")
        if after.where("comp <> before").isEmpty():
            return after.select("node", "comp")
        labels = after.select("node", "comp")
