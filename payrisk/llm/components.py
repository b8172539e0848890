"""Connected components of a stored table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payrisk.llm.common import narrowed, stored


def components(links: DataFrame) -> DataFrame:
    """(a, b) -> (node, label): the smallest node reachable, for every node with a link.

    Each round takes the least label among a node's neighbours, then the label of that label,
    which halves the remaining distances. Labels are written between rounds.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(narrowed(both.distinct(), 2 * links.count()), "links")
    rows = both.count()

    def written(df: DataFrame) -> DataFrame:
        return stored(narrowed(df, rows), "labels")

    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        seen = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        nearer = labels.join(seen, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        nearer = written(nearer)
        if nearer.filter(F.col("label") != F.col("old")).isEmpty():
            return nearer.select("node", "label")
        jump = nearer.select(F.col("node").alias("via"), F.col("label").alias("further"))
        labels = written(
            nearer.join(jump, F.col("label") == F.col("via")).select(
                "node", F.least("label", "further").alias("label")
            )
        )
