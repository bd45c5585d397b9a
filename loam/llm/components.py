"""Connected components over a table of links, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm.shared import grown, stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``: root is the smallest node it can reach.

    Each round hooks every node's label to the smallest label next to it, then halves the
    paths. Labels move by joins and minima only, so a node with very many neighbours is
    pre-aggregated like any other key. Rounds grow with the logarithm of the diameter.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    both = stage(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = stage(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("label")), "labels")
    while True:
        near = both.join(grown(labels.withColumnRenamed("node", "v")), "v").groupBy("u").agg(F.min("label").alias("near"))
        hooked = labels.join(grown(near), labels["node"] == near["u"], "left").select("node", "label", F.least("label", F.coalesce("near", "label")).alias("next"))
        # A label that sees a smaller one hands it to all that carry the label.
        parent = hooked.groupBy("label").agg(F.min("next").alias("to"))
        moved = stage(
            hooked.join(grown(parent), "label").select("node", "label", F.least("next", "to").alias("next")), "hooked"
        )
        jump = moved.select(F.col("node").alias("n"), F.col("next").alias("further"))
        after = stage(
            moved.join(grown(jump), moved["next"] == jump["n"], "left").select("node", F.col("label").alias("old"), F.least("next", F.coalesce("further", "next")).alias("label")), "labels"
        )
        changed = after.where("label <> old").limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels.withColumnRenamed("label", "root")
