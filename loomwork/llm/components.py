"""Connected components over a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.tables import beside
from .common import materialise


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b (long; each link in both directions).  Returns node, label: the smallest node reachable.

    Every round takes the smallest label among a node and its neighbours, then
    the label that this one had before the round, so paths halve.  Labels only
    fall, so an unchanged sum means that none changed.  Each round is one table
    in the shared folder, so the driver starts few commits; sums of minima are
    taken before the shuffle, and what has many links is read from written
    tables on both sides, so a node with very many links can be split.
    """
    edges = materialise(edges, "edges")
    labels = materialise(edges.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")), "labels")
    total = None
    while True:
        near = beside(edges, labels, edges["b"] == labels["node"]).select(F.col("a").alias("node"), "label")
        low = near.unionByName(labels).groupBy("node").agg(F.min("label").alias("label"))
        before = labels.select(F.col("node").alias("at"), F.col("label").alias("next"))
        labels = materialise(beside(low, before, low["label"] == before["at"]).select("node", F.col("next").alias("label")), "labels")
        now = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if now == total:
            return labels
        total = now
