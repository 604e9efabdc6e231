"""Connected components of links that no machine holds together."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every neighbour above a node to the least of its neighbours and itself."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "components-least")
    # stored, so that the join is one of plain exchanges, in which a hub's rows can be split
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its neighbours below it to the least of them; edges have u > v."""
    least = stage(edges.groupBy("u").agg(F.min("v").alias("m")), "components-least")
    joined = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """The least node reachable from each node, for links ``(u, v)`` of long nodes.

    Large-star and small-star rounds take turns until the links no longer change, which for stars
    is at once and otherwise takes a number of rounds that grows with the logarithm of the nodes.
    A hub's links are summed before the shuffle and split over tasks in the joins.  Every round's
    links are stored, so a lost executor costs no earlier round.  Returns ``node, component`` for
    nodes with a link other than to themselves; links with a null end are none.
    """
    links = edges.filter("u is not null and v is not null and u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    links = stage(links.distinct(), name)
    mark = None
    while True:
        now = links.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
        links = stage(_small_star(_large_star(links).distinct()), name)
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(roots)
