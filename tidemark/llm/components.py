"""Connected components of an edge table, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, scratch


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the label is the smallest node of its component.

    Each round, every class of equal labels takes the smallest label next to any of its members, and
    then every node takes the label of its label. So a round merges whole classes, and the way to
    the end of a chain at least halves. Labels are aggregated before they move; a class that most
    nodes belong to is split by the skew join.
    """
    both = scratch(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "cc-edges")
    labels = scratch(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"), "cc")
    for _ in range(rounds):
        near = (both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near")))
        seen = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("low"))
        move = scratch(seen.groupBy("label").agg(F.min("low").alias("to")), "cc-moves")
        if move.where("to <> label").isEmpty():
            discard(both, move)
            return labels
        moved = scratch(labels.join(move, "label").select("node", F.least("label", "to").alias("label")), "cc-moved")
        discard(labels, move)
        over = moved.select(F.col("node").alias("label"), F.col("label").alias("end"))
        labels = scratch(moved.join(over, "label").select("node", F.col("end").alias("label")), "cc")
        discard(moved)
    raise RuntimeError(f"components did not settle in {rounds} rounds")
