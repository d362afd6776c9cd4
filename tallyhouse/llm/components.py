"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.storage import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b): the label is the least node reachable.

    Each round gives a node the least of itself and its neighbours, then the label of that label, and
    contracts the edges to labels; a round at least halves the nodes that still have edges, so the
    later rounds are small. Minima are combined before the shuffle, and every round is stored, so a
    lost executor repeats one round at most. Null ends are left out; empty edges give no node.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    edges = stage(edges, "edges")
    labels = None
    while labels is None or not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        near = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("near"))
        near = stage(near, "near")
        jump = near.select(F.col("node").alias("at"), F.col("near").alias("further"))
        moved = near.join(jump, near["near"] == jump["at"]).select(F.col("node").alias("from_"), F.col("further").alias("to_"))
        moved = stage(moved, "moved")
        if labels is None:
            labels = moved.toDF("node", "label")
        else:
            old = labels.join(moved, labels["label"] == moved["from_"], "left")
            labels = stage(old.select("node", F.coalesce("to_", "label").alias("label")), "labels")
        ends = edges.join(moved, edges["a"] == moved["from_"]).select(F.col("to_").alias("x"), "b")
        ends = ends.join(moved, ends["b"] == moved["from_"]).select("x", F.col("to_").alias("y"))
        ends = ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        edges = stage(ends.distinct(), "edges")
    return labels
