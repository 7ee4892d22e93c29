"""Connected components of a graph given by its edges, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm import text as T


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable over the edges (a, b), for every node of an edge.

    In each round every node points to the smallest of itself and its neighbours, and every edge
    moves to the nodes its ends point to; edges with one end left are dropped. Each round at
    least halves the nodes that still have edges. Rounds are written to the shared folder; only
    counts come to the driver.
    """
    edges = T.written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                                   F.least("a", "b").alias("b")).distinct(),
                      "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = (both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to"))
                  .select("node", F.least("node", "to").alias("to")))
        for _ in range(2):  # point to what that points to
            onward = points.select(F.col("node").alias("to"), F.col("to").alias("next"))
            points = points.join(onward, "to").select("node", F.col("next").alias("to"))
        points = T.written(points, "points")
        first = points.select(F.col("node").alias("a"), F.col("to").alias("x"))
        second = points.select(F.col("node").alias("b"), F.col("to").alias("y"))
        edges = T.written(
            edges.join(first, "a").join(second, "b").where("x <> y")
            .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(),
            "edges")
        if labels is None:
            labels = points.select("node", F.col("to").alias("root"))
        else:
            onward = points.select(F.col("node").alias("root"), "to")
            labels = (labels.join(onward, "root", "left")
                      .select("node", F.coalesce("to", "root").alias("root")))
        labels = T.written(labels, "labels")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
