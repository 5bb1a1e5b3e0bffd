"""Connected components of a table of edges, by contracting the graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nivalis.llm.common import materialise


def _distinct(edges: DataFrame) -> DataFrame:
    return materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct())


def components(edges: DataFrame) -> DataFrame:
    """node and label (the smallest node it is connected to) of each node of edges (a long, b long).

    In each round every node joins its smallest neighbour, and that one's, if smaller; edges between
    what is left are the next round's, which are far fewer.
    """
    edges = _distinct(edges)
    rounds: list[DataFrame] = []
    while not rounds or not edges.isEmpty():
        ends = edges.select(F.col("a").alias("node"), "b").union(edges.select("b", "a"))
        near = materialise(ends.groupBy("node").agg(F.least(F.min("b"), F.col("node")).alias("near")))
        beyond = near.select(F.col("node").alias("near"), F.col("near").alias("label"))
        rounds.append(materialise(near.join(beyond, "near").select("node", "label")))
        of = lambda end: rounds[-1].select(F.col("node").alias(end), F.col("label").alias(f"{end}_label"))
        moved = edges.join(of("a"), "a").join(of("b"), "b")
        edges = _distinct(moved.select(F.col("a_label").alias("a"), F.col("b_label").alias("b")))
    labels = rounds[0]
    for later in rounds[1:]:
        step = later.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels = labels.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    return materialise(labels)
