"""Connected components by minimum labels, in rounds over tables in shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import passing_scratch, settle


def connected(links: DataFrame) -> DataFrame:
    """node, component (its smallest reachable node) for every node of ``links`` (a, b).

    Each round takes the least label among the neighbours and then the label of that
    label, so a chain halves in length. All labels fall, so their sum tells the end.
    Nodes are whole numbers.
    """
    spark = links.sparkSession
    with passing_scratch(spark) as keep:
        both = links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct()
        both = settle(both, "links")
        labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels")
        total = None
        while (now := labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]) != total:
            total = now
            near = (
                both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
            )
            low = labels.join(near, "node").select("node", F.least("label", "near").alias("low"))
            ahead = labels.select(F.col("node").alias("low"), F.col("label").alias("ahead"))
            labels = settle(low.join(ahead, "low").select("node", F.least("low", "ahead").alias("label")), "labels")
        keep(labels)
    return labels.select("node", F.col("label").alias("component"))
