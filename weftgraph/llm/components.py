"""Connected components of link tables, by contraction: no link or label passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) of every node of ``links`` (columns a, b); component is the smallest id reachable.

    Each round points every node to its smallest neighbour, follows pointers to
    their end by doubling, and contracts the links; rounds grow with the logarithm of
    the longest path.  Tables are written to the shared folder between rounds.
    """
    links = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    labels = None
    while not links.isEmpty():
        both = links.select(F.col("a").alias("id"), F.col("b").alias("to")).unionByName(links.select(F.col("b").alias("id"), F.col("a").alias("to")))
        up = stored(both.groupBy("id").agg(F.min("to").alias("to")).select("id", F.least("id", "to").alias("to")))
        while True:
            after = up.select(F.col("id").alias("to"), F.col("to").alias("far"))
            up = stored(up.join(after, "to").select("id", F.col("far").alias("to"), (F.col("far") != F.col("to")).alias("moved")))
            if up.where("moved").isEmpty():
                break
            up = up.select("id", "to")
        up = up.select("id", "to")
        if labels is None:
            labels = up.select("id", F.col("to").alias("component"))
        else:
            labels = stored(labels.join(up.select(F.col("id").alias("component"), "to"), "component", "left").select("id", F.coalesce("to", "component").alias("component")))
        left = links.join(up.select(F.col("id").alias("a"), F.col("to").alias("x")), "a").join(up.select(F.col("id").alias("b"), F.col("to").alias("y")), "b")
        links = stored(left.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if labels is None:
        return links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return labels
