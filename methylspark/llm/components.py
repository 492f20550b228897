"""Connected components by contraction, all in distributed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from methylspark.llm.common import Workspace


def components(edges: DataFrame, space: Workspace) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b: long): the smallest node reachable.

    Each round hooks every node to its smallest neighbour, follows parents twice and contracts the graph. Nodes that no
    neighbour undercuts stay roots, so at least half the nodes go with each round. Every table is written and read again:
    nothing comes to the driver but whether edges are left, and joins on a hot node are plain shuffles that can be split.
    """
    e = edges.where("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    e = space.put(e, "edges", narrow=True)
    labels = None
    while not e.isEmpty():
        both = e.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(e.select(F.col("b").alias("node"), F.col("a").alias("other")))
        parents = space.put(both.groupBy("node").agg(F.min("other").alias("p")).select("node", F.least("node", "p").alias("parent")), "parents", narrow=True)
        for _ in range(2):
            up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
            nearer = space.put(parents.join(up, "parent").select("node", F.col("above").alias("parent")), "parents", narrow=True)
            space.drop(parents)
            parents = nearer
        pa_, pb = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa")), parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        left = e.join(pa_, "a").join(pb, "b").where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        left = space.put(left, "edges", narrow=True)
        if labels is None:
            labels = parents.select("node", F.col("parent").alias("label"))
        else:
            up = parents.select(F.col("node").alias("label"), F.col("parent").alias("above"))
            labels = space.put(labels.join(up, "label", "left").select("node", F.coalesce("above", "label").alias("label")), "labels", narrow=True)
        space.drop(e)
        e = left
    if labels is None:
        labels = e.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
