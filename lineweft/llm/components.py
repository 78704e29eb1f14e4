"""Connected components of an edge table, by hooking nodes to least neighbours and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineweft.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of an edge (a, b): the least node of its component.

    In a round each node hooks to its least neighbour if that is smaller, parents are
    replaced by their parents, and the edges are rewritten between what is left, each once.
    Every node that has an edge either goes or takes a neighbour in, so a round at least
    halves them, chains included, and the edges of all rounds together stay a small multiple of
    the first ones. Rounds are written tables. Least neighbours are a map-side ``min``, so a
    node of high degree costs a row per task.
    """
    left = cut_lineage(_ordered(edges.select("a", "b")))
    nodes = left.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = nodes.select("node", F.col("node").alias("label"))
    while not left.isEmpty():
        ways = [F.struct(F.col(x).alias("node"), F.col(y).alias("near")) for x, y in ("ab", "ba")]
        each_way = left.select(F.inline(F.array(*ways)))
        parents = cut_lineage(each_way.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("parent")))
        above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        moves = cut_lineage(parents.join(above, "parent").select("node", F.col("above").alias("label")))
        of_a = moves.select(F.col("node").alias("a"), F.col("label").alias("to_a"))
        of_b = moves.select(F.col("node").alias("b"), F.col("label").alias("to_b"))
        rewritten = left.join(of_a, "a").join(of_b, "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
        left = cut_lineage(_ordered(rewritten))
        of_label = moves.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = cut_lineage(
            labels.join(of_label, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
        )
    return labels


def _ordered(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
