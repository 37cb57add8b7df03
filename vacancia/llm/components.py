"""Connected components by contracting edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b); root is the smallest node.

    Each round every node takes its smallest neighbour's pointer, nodes are replaced by
    what they point to, and edges inside a merged node go. A star is done in one round, a
    path in a number of rounds that grows with the logarithm of its length. Tables are
    written each round, in files for the edges that are left; nothing is collected but
    their count.
    """
    edges = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = stored(edges.distinct(), "edges", edges.count())
    first = left = edges.count()
    labels = None
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = stored(both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.first("a"), F.min("b")).alias("root")), "pointers", 2 * left)
        jump = point.select(F.col("node").alias("root"), F.col("root").alias("next"))
        point = stored(point.join(jump, "root", "left").select(
            "node", F.coalesce("next", "root").alias("root")), "jumped", 2 * left)
        if labels is None:
            labels = point
        else:
            step = point.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = stored(labels.join(step, "root", "left").select(
                "node", F.coalesce("next", "root").alias("root")), "labels", 2 * first)
        of = lambda side: point.select(F.col("node").alias(side), F.col("root").alias(f"r{side}"))
        edges = stored(
            edges.join(of("a"), "a").join(of("b"), "b")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .filter("a <> b").distinct(), "edges", left)
        left = edges.count()
        if not left:
            return labels
