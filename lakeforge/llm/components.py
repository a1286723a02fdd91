"""Connected components by smallest labels, with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm import store


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for edges (a, b) of bigints: the smallest node that can
    be reached. Each round takes the smallest label among a node and its
    neighbours, then the label of that label; labels only fall, and the rounds
    end when none does. Neighbours' labels are combined before they are
    shuffled, so a node with very many edges is no hot key."""
    both = store.save(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = store.save(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        lower = store.save(lower, "labels")
        to = lower.select(F.col("node").alias("of"), F.col("label").alias("jump"))
        after = store.save(lower.join(to, F.col("label") == F.col("of")).select("node", F.col("jump").alias("label"), (F.col("jump") < F.col("old")).alias("fell")), "labels")
        labels = after.select("node", "label")
        if after.where("fell").isEmpty():
            return labels.withColumnRenamed("label", "component")
