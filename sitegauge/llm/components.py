"""Connected components of a graph given as links, without collecting any neighbourhood."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.sources.workdir import stored


def _shortcut(parents: DataFrame) -> DataFrame:
    """``node`` to the end of its chain of parents; chains are halved until none is left."""
    while True:
        up = parents.select(F.col("node").alias("_node"), F.col("parent").alias("_up"))
        jumped = parents.join(up, F.col("parent") == F.col("_node"), "left").select(
            "node", F.coalesce("_up", "parent").alias("parent"), F.col("_up").isNotNull().alias("_moved")
        )
        jumped = stored(jumped, "parents")
        moved = not jumped.where("_moved").isEmpty()
        parents = jumped.drop("_moved")
        if not moved:
            return parents


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node of ``links`` (a, b).

    Each round every node with a smaller neighbour takes the smallest as parent (a sum that
    map tasks begin, so a node of any degree is one row per task), chains of parents are cut
    short, and links between what is left are carried over; links within a tree go. No link
    gives no rows; loops and repeated links change nothing.
    """
    kind = links.schema["a"].dataType
    labels = None
    left = stored(links.where("a <> b").select("a", "b").distinct(), "links")
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.where("b < a").groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))
        roots = _shortcut(stored(parents, "hooks"))
        if labels is None:
            labels = roots.select("node", F.col("parent").alias("component"))
        else:
            moved = roots.select(F.col("node").alias("component"), "parent")
            labels = (
                labels.join(moved, "component", "left")
                .select("node", F.coalesce("parent", "component").alias("component"))
                .unionByName(roots.select("node", F.col("parent").alias("component")))
                .groupBy("node")
                .agg(F.min("component").alias("component"))
            )
        labels = stored(labels, "labels")
        for side in ("a", "b"):
            moved = roots.select(F.col("node").alias(side), F.col("parent").alias("_to"))
            left = left.join(moved, side, "left").withColumn(side, F.coalesce("_to", side)).drop("_to")
        left = stored(left.where("a <> b").select("a", "b").distinct(), "links")
    if labels is None:
        empty = links.select(F.col("a").cast(kind).alias("node"), F.col("b").cast(kind).alias("component"))
        return empty.where(F.lit(False))
    ends = labels.select(F.col("component").alias("node"), "component").distinct()
    return labels.unionByName(ends).groupBy("node").agg(F.min("component").alias("component"))
