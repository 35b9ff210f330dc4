"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewatch.llm.support import cut


def _to_smallest(links: DataFrame, up: bool) -> DataFrame:
    """Each node's neighbours are linked to the smallest of them and itself.

    With `up` the larger neighbours are linked, else the smaller ones and the node.
    """
    if up:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    smallest = both.groupBy("a").agg(F.min("b").alias("low")).select(
        F.col("a").alias("node"), F.least("a", "low").alias("low")
    )
    near = both.join(smallest, both["a"] == smallest["node"])
    if up:
        moved = near.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        moved = near.select(F.col("b").alias("a"), F.col("low").alias("b")).union(
            smallest.select(F.col("node").alias("a"), F.col("low").alias("b"))
        )
    return moved.filter(F.col("a") != F.col("b")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for each node in `links` (a, b): the smallest node reachable from it.

    Large-star and small-star steps in turn until nothing changes: the number of links never grows
    and the number of rounds grows with the logarithm of the longest path. Minima are combined
    before the shuffle, so a hub sends one row per task.
    """
    links = cut(links.filter(F.col("a") != F.col("b")).select("a", "b").distinct())
    before = None
    while True:
        state = links.agg(
            F.count("*").alias("rows"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"),
        ).first()
        if state["rows"] == 0 or state == before:
            break
        before = state
        links = cut(_to_smallest(_to_smallest(links, up=True), up=False))
    # all links now lead to the smallest node
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
