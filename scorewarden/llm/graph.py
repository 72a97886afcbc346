"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorewarden.llm.common import settled


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b): root is the smallest node it is connected with.

    Labels spread over links and then jump to the label of their label, so that long chains shorten fast. Every round is
    written to shared storage; only the number of changes reaches the driver. Null nodes and an empty table give no rows.
    """
    links = links.select("a", "b").dropna()
    both = settled(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).dropDuplicates(["a", "b"]))
    labels = settled(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_least")).select("node", F.least("node", "_least").alias("root")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("_near"))
        lower = labels.join(near, "node").select("node", F.col("root").alias("_old"), F.least("root", "_near").alias("_new"))
        jump = labels.select(F.col("node").alias("_new"), F.col("root").alias("_far"))
        moved = settled(lower.join(jump, "_new", "left").select(
            "node", F.least("_new", F.coalesce("_far", "_new")).alias("root"), "_old"))
        if moved.where(F.col("root") != F.col("_old")).isEmpty():
            return moved.select("node", "root")
        labels = moved.select("node", "root")
