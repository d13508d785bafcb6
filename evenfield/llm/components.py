"""Connected components of a table of links by alternating large-star and small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame) -> DataFrame:
    """(key, label) of every key that a link (a, b) names; the label is the smallest key of its component.

    Each round lets every key point its larger neighbours (then its smaller ones and itself) at the smallest key it
    sees. The number of links never grows and the rounds grow with the logarithm of a component's size. A round is
    kept in the shared folder, so its lineage is cut. Self links and repeated links don't matter.
    """
    edges = cut(links.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        # large star: neighbours above u point at the least of u and its neighbours
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        # small star: u and its smaller neighbours point at the least of them
        lows = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(lows, "u").select(F.explode(F.array("u", "v")).alias("x"), "low").filter("x != low").select(F.col("x").alias("u"), F.col("low").alias("v")).distinct()
        after = cut(small)
        same = after.join(edges, ["u", "v"], "left_anti").isEmpty() and edges.join(after, ["u", "v"], "left_anti").isEmpty()
        edges = after
        if same:
            break
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("key"), F.col("v").alias("label")).unionByName(roots.select(F.col("v").alias("key"), F.col("v").alias("label")))
