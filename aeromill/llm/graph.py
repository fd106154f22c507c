"""Connected components by label spreading with pointer jumping; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeromill.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that can be reached over ``edges`` (a, b: long).

    Each round takes the least label among a node and its neighbours, then the label of that
    label, so long chains shorten by half. Every round is written to the shared folder, and
    joins are plain equi-joins, which Spark splits where one node has very many links. Nodes
    without an edge do not appear; no edges give no rows.
    """
    both = materialise(edges.where("a != b").select("a", "b").union(edges.where("a != b").select("b", "a")).distinct(), "edges")
    labels = materialise(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("component")), "labels")
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, labels["node"] == near["a"], "left").select("node", F.col("component").alias("old"), F.least("component", "near").alias("mid"))
        up = labels.select(F.col("node").alias("up_node"), F.col("component").alias("up"))
        new = materialise(
            lower.join(up, lower["mid"] == up["up_node"], "left").select("node", "old", F.least("mid", "up").alias("component")), "labels"
        )
        if new.where("component < old").limit(1).count() == 0:
            return new.select("node", "component")
        labels = new.select("node", "component")
