"""Connected components of an edge table, as joins and aggregates."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.llm.joins import shuffled
from specloom.session import written

# Edges that the driver joins by itself, of two numbers each; the rounds of more take less time on the cluster.
LOCAL_EDGES = 100_000


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) of all nodes of (a, b) edges; label is the smallest node of the component.

    Every round takes the smallest label among neighbours and then the label of that label, so long
    chains shorten by halves. Neighbours are reduced before the shuffle, whatever a node's degree; labels
    are written each round. An empty table gives an empty one.
    """
    edges = edges.select("a", "b").where("a <> b")
    both = written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("label")))
    while True:
        near = both.join(shuffled(labels), both.b == labels.node).groupBy("a").agg(F.min("label").alias("low"))
        lower = labels.join(shuffled(near), labels.node == near.a, "left").select("node", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("further"))
        moved = lower.join(shuffled(jump), lower.label == jump["at"], "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label"))
        moved = written(moved)
        if moved.where("old <> label").isEmpty():
            return shuffled(moved.select("node", "label"))
        labels = moved.select("node", "label")


def linked_labels(labels: DataFrame, edges: DataFrame, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """The labels (node, label) that `connected_components` gives for the edges of earlier labels and further
    ones (a, b) together. Only the further edges are followed, between labels instead of nodes."""
    edges = edges.select("a", "b").where("a <> b")
    for end in ("a", "b"):
        named = labels.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}"))
        edges = edges.join(shuffled(named), end, "left")
    edges = edges.select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    edges = written(edges.where("a <> b").distinct())
    joined = _local_components(edges) if edges.count() <= local_edges else connected_components(edges)
    lower = joined.select(F.col("node").alias("label"), F.col("label").alias("lower"))
    known = labels.join(shuffled(lower), "label", "left").select("node", F.coalesce("lower", "label").alias("label"))
    new = joined.join(shuffled(labels.select("node")), "node", "left_anti").select("node", "label")
    return shuffled(written(known.unionByName(new)))


def _local_components(edges: DataFrame) -> DataFrame:
    """`connected_components` of few edges, in the driver."""
    label: dict[int, int] = {}

    def top(x: int) -> int:
        while label.setdefault(x, x) != x:
            label[x] = x = label[label[x]]
        return x

    both = edges.select("a", "b").toArrow()
    for a, b in zip(both.column("a").to_pylist(), both.column("b").to_pylist(), strict=True):
        low, high = sorted((top(a), top(b)))
        label[high] = low
    nodes = list(label)
    out = pa.table({"node": pa.array(nodes, pa.int64()), "label": pa.array([top(x) for x in nodes], pa.int64())})
    return edges.sparkSession.createDataFrame(out)
