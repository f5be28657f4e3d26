"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from evalspark.session import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that ``links`` (a, b) names; nulls are not allowed.

    In each round every node points at its smallest neighbour if that is smaller than
    itself, pointers are followed twice, and links are redrawn between the nodes pointed
    at. Rounds end when no link is left; links between random numbers at least
    halve per round. All of it is joins and aggregates; the driver sees one count.
    """

    def both(pairs: DataFrame) -> DataFrame:
        return pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()

    edges = materialise(both(links.filter("a <> b").select("a", "b")), "links")
    labels = None
    while edges.limit(1).count():
        up = edges.groupBy("a").agg(F.min("b").alias("b"))
        up = materialise(up.select("a", F.least("a", "b").alias("to")), "parents")
        over = up.select(F.col("a").alias("to"), F.col("to").alias("next"))
        for _ in range(2):
            up = up.join(over, "to").select("a", F.col("next").alias("to"))
        up = materialise(up, "parents")
        if labels is None:
            labels = up.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            step = up.select(F.col("a").alias("root"), F.col("to").alias("_to"))
            labels = labels.join(step, "root", "left")
            labels = labels.select("node", F.coalesce("_to", "root").alias("root"))
        labels = materialise(labels, "labels")
        ends = up.select(F.col("a").alias("b"), F.col("to").alias("_b"))
        edges = edges.join(up, "a").join(ends, "b").filter("to <> _b")
        edges = materialise(both(edges.select(F.col("to").alias("a"), F.col("_b").alias("b"))), "links")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
