"""Connected components of a table of links, on the executors.

Every node points to a smaller node it is linked with; in each round all
neighbours of a node learn the smallest of them (large star), then what points
to a node learns its smallest (small star). Rounds halve the remaining depth and
end when no pointer changes. Nothing but two numbers of a round comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import done_with, stored

MOST_ROUNDS = 60


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Edges (node, least): each neighbour points to the smallest of a node and its neighbours."""
    if larger:  # neighbours on both sides; those above the node move to the smallest
        sides = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:  # each edge once, from its larger end
        sides = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = sides.join(least, "u")
    if larger:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (columns u, v): the smallest node it is connected with."""
    edges = stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    sign = None
    for _ in range(MOST_ROUNDS):
        before, edges = edges, stored(_star(_star(edges, True), False), "stars")
        done_with(before)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == tuple(now):
            break
        sign = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    found = edges.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("node"), "label")
    return found.union(found.select("label").distinct().select(F.col("label").alias("node"), "label"))
