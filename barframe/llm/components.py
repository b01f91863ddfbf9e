"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barframe.session import cut_lineage


HUBS = 100_000  # nodes whose links are joined without a shuffle, at most
HUB_LINKS = 256  # links of such a node, at least


def _star(edges: DataFrame, large: bool, crowd: int) -> DataFrame:
    """Links of nodes to the least node next to them. ``edges`` has ``u > v``, once each.

    A large star moves the larger neighbours of a node, a small star the node and its smaller ones.
    Nodes of more than ``crowd`` links meet theirs by a broadcast, so no key of a shuffle has more rows.
    """
    near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = near.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).withColumn("m", F.least("node", "m"))
    centre = "v" if large else "u"
    hubs = least.where(F.col("n") > crowd).select(F.col("node").alias("hub"), F.col("m").alias("hub_m"))
    placed = edges.join(F.broadcast(hubs), F.col(centre) == F.col("hub"), "left")
    at_hubs = placed.where("hub is not null").select("u", "v", F.col("hub_m").alias("m"))
    others = placed.where("hub is null").join(least.where(F.col("n") <= crowd), F.col(centre) == F.col("node")).select("u", "v", "m")
    joined = at_hubs.unionByName(others)
    if large:
        moved = joined.select("u", F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("node").alias("u"), F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node with a link to another node; the component is its least node.

    Links may repeat, in either direction; loops and nulls are ignored. The number of rounds grows
    with the logarithm of the longest path; each round is a few grouped minima and joins, checkpointed
    in the folder of ``spark.checkpoint.dir``, and only a count and a sum come to the driver. Nodes of
    more than 256 links and of a 50,000th of all are joined by a broadcast: at most ``HUBS`` rows, since
    every link has two ends.
    """
    edges = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = cut_lineage(edges)
    mark = None
    while True:
        seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark or not seen[0]:
            break
        mark = seen
        crowd = max(HUB_LINKS, 2 * seen[0] // HUBS)  # a star has no more links than it was made of
        edges = cut_lineage(_star(_star(edges, True, crowd), False, crowd))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
