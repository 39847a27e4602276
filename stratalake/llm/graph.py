"""Connected components of an edge table by label propagation with pointer jumping, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm import store


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of the component of every node of ``edges`` (a, b).

    Every round takes the smallest label among neighbours and then the label of that label; a hub's
    neighbours are reduced to one minimum before they meet. Labels only fall, so the loop ends.
    """
    both = store.keep(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = store.keep(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        low = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = store.keep(low.join(jump, "label", "left").select("node", "was", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        changed = after.where("label < was").limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels
