"""Connected parts of a graph whose links are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.tables import settled


def parts(links: DataFrame) -> DataFrame:
    """node, part: the smallest node that a, b (links, either way round, whole numbers) lead to from each node.

    A round hooks every node's root onto the smallest root among its neighbours'
    and then halves the paths; rounds grow with the logarithm of the longest path.
    Sums of minima are taken before the shuffle, so a node with very many links
    is no larger than another.
    """
    both = settled(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "links")
    roots = settled(links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("part", F.col("node")), "parts")
    while True:
        own = roots.select(F.col("node").alias("a"), F.col("part").alias("mine"))
        near = both.join(roots, both["b"] == roots["node"]).groupBy("a").agg(F.min("part").alias("least")).join(own, "a")
        hooks = near.where("least < mine").groupBy(F.col("mine").alias("node")).agg(F.min("least").alias("to"))
        hooks = settled(hooks, "hooks")
        if hooks.isEmpty():
            return roots
        hooked = settled(roots.join(hooks.withColumnRenamed("node", "root"), F.col("part") == F.col("root"), "left").select("node", F.least("part", F.coalesce("to", "part")).alias("part")), "parts")
        for _ in range(2):
            up = hooked.select(F.col("node").alias("at"), F.col("part").alias("next"))
            hooked = settled(hooked.join(up, hooked["part"] == up["at"]).select("node", F.col("next").alias("part")), "parts")
        roots = hooked
