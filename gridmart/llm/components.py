"""Connected components by joins: nodes are merged into their smallest neighbours, and edges shrink as they go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.llm.common import staged


def _edges(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for edges (a, b): the label is the component's smallest node.

    Each round merges a node into its smallest neighbour, and into what that one is merged into, so long chains shorten
    quickly. Edges between nodes that are now one go, so a round works on what is still apart. Nothing reaches the driver but
    whether edges are left. Nodes with very many edges are pre-aggregated.
    """
    live = staged(edges.select(*_edges(F.col("a"), F.col("b"))).where("a <> b").distinct(), "edges")
    labels = None
    while True:
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = staged(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("to")), "nearest")
        further = nearest.select(F.col("node").alias("via"), F.col("to").alias("next"))
        merged = staged(nearest.join(further, F.col("to") == F.col("via")).select("node", F.col("next").alias("to")), "merged")
        if labels is None:
            labels = merged.select("node", F.col("to").alias("label"))
        else:
            moves = merged.select(F.col("node").alias("old"), "to")
            told = labels.join(moves, F.col("label") == F.col("old"), "left")
            labels = staged(told.select("node", F.coalesce("to", "label").alias("label")), "labels")
        left, right = merged.toDF("a", "x"), merged.toDF("b", "y")
        apart = live.join(left, "a").join(right, "b").where("x <> y").select(*_edges(F.col("x"), F.col("y")))
        live = staged(apart.distinct(), "edges")
        if live.isEmpty():
            return labels
