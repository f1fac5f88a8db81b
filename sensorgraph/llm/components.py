"""Connected components by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgraph.operators.storage import stored


def components(edges: DataFrame) -> DataFrame:
    """``id, label`` for all ends of ``edges`` (``a``, ``b``): the smallest id that can be reached.

    Each round takes the least label among the neighbours, then the label of the label; labels are written each round, so
    lineage stays short and a lost executor costs one round. A hub's neighbours are reduced before the shuffle.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stored(both, "edges")
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "id"), "labels")
    while True:
        of_b = labels.select(F.col("id").alias("b"), F.col("label").alias("seen"))
        least = both.join(of_b, "b").groupBy(F.col("a").alias("id")).agg(F.min("seen").alias("seen"))
        lower = labels.join(least, "id").select("id", F.least("label", "seen").alias("next"), "label")
        lower = stored(lower, "lower-labels")
        jump = lower.select(F.col("id").alias("next"), F.col("next").alias("far"))
        moved = lower.join(jump, "next").select("id", F.least("next", "far").alias("label"), F.col("label").alias("old"))
        moved = stored(moved, "labels")
        if moved.where("label < old").isEmpty():
            return moved.select("id", "label")
        labels = moved.select("id", "label")
