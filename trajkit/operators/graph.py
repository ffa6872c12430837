"""Graph operators on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajkit.session import sent_if_small, written


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``node, component`` (its smallest node) of undirected edges, as a written table; rows with a null end are left out.

    Each round points every node at its smallest neighbour, follows the pointers four steps and
    contracts the edges, so the rounds are few and what is left of the edges shrinks fast. A round
    writes the pointers and the edges that are left; nodes meet the pointers of all rounds once, at
    the end. The pointers of later rounds, where many nodes share one, are sent to all while few.
    """
    known = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")
    known = written(known.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "graph-edges")
    links, rounds = known.filter("a <> b"), []
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        up = both.groupBy(F.col("a").alias("x")).agg(F.min("b").alias("m")).select("x", F.least("x", "m").alias("p"))
        for _ in range(2):
            up = up.join(up.select(F.col("x").alias("p"), F.col("p").alias("q")), "p").select("x", F.col("q").alias("p"))
        up = written(up, "graph-up")
        rounds.append(up)
        ends = links.join(up.select(F.col("x").alias("a"), F.col("p").alias("pa")), "a").join(up.select(F.col("x").alias("b"), F.col("p").alias("pb")), "b")
        links = written(ends.filter("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "graph-edges")
    nodes = known.select(F.col("a").alias("node")).union(known.select("b")).distinct().select("node", F.col("node").alias("component"))
    for i, up in enumerate(rounds):
        to = up.select(F.col("x").alias("component"), "p")
        nodes = nodes.join(sent_if_small(to) if i else to, "component", "left").select("node", F.coalesce("p", "component").alias("component"))
    return written(nodes, "graph-nodes")
