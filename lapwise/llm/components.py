"""Connected components of a table of links, by contraction in a random order, with each round written out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.operators.staging import remove, stage


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) for all nodes of the links (a, b); the component is its smallest node.

    In each round every node joins the node of its neighbourhood that comes first by hash, and links are drawn between
    what they joined; in random order that removes a fixed share of the nodes a round, also on long chains, and all
    of a star at once. Nodes and links are narrow rows; a node with very many links is summed up by partial minima.
    """
    edges = stage(links.select("a", "b").filter("a <> b").distinct())
    labels = None
    while True:
        near = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).union(
            edges.select(F.col("b").alias("node"), F.col("a").alias("near"))
        )
        own = F.struct(F.xxhash64("node").alias("order"), F.col("node").alias("near"))
        first = F.min(F.struct(F.xxhash64("near").alias("order"), F.col("near")))
        joined = stage(
            near.groupBy("node").agg(first.alias("first")).select("node", F.least("first", own)["near"].alias("root"))
        )
        if labels is None:
            labels = joined
        else:
            further = joined.select(F.col("node").alias("root"), F.col("root").alias("further"))
            moved = stage(labels.join(further, "root", "left").select("node", F.coalesce("further", "root").alias("root")))
            remove(labels)
            labels = moved
        fewer = stage(
            edges.join(joined.select(F.col("node").alias("a"), F.col("root").alias("x")), "a")
            .join(joined.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
            .filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
        )
        remove(edges)
        if joined is not labels:
            remove(joined)
        edges = fewer
        if edges.isEmpty():
            break
    named = labels.groupBy("root").agg(F.min("node").alias("component"))
    found = stage(labels.join(named, "root").select("node", "component"))
    remove(labels)
    remove(edges)
    return found
