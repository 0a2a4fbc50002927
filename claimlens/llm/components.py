"""Connected components of a link table by contraction: every node moves to its smallest neighbour, links follow.

Ids are hashes, so each round leaves about a third of the nodes that still have links; tables of a round are written
to the shared folder and read again, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.session import stage


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b) that is not itself the smallest of its component."""
    links = stage(links.where("a <> b").select("a", "b").distinct(), "links")
    moves: list[DataFrame] = []
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        move = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to")).where("to < node")
        move = stage(move, "moves")
        moves.append(move)
        first = move.select(F.col("node").alias("a"), F.col("to").alias("a_to"))
        second = move.select(F.col("node").alias("b"), F.col("to").alias("b_to"))
        moved = links.join(first, "a", "left").join(second, "b", "left")
        moved = moved.select(F.coalesce("a_to", "a").alias("a"), F.coalesce("b_to", "b").alias("b"))
        links = stage(moved.where("a <> b").distinct(), "links")
    if not moves:
        return links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = moves.pop().select("node", F.col("to").alias("label"))
    while moves:
        later = labels.select(F.col("node").alias("to"), "label")
        resolved = moves.pop().join(later, "to", "left").select("node", F.coalesce("label", "to").alias("label"))
        labels = stage(resolved.unionByName(labels).groupBy("node").agg(F.min("label").alias("label")), "labels")
    return labels
