"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: every node's neighbours are linked to the smallest of them.

    ``large`` moves the neighbours above a node, the other step those below it; only the
    other's edges are made distinct.  The
    minimum is combined in each task and joined back, so a node with most of the links is
    never gathered; the adaptive skew join splits its rows.
    """
    if large:
        edges = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    joined = edges.join(least, "a")
    if large:
        joined = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        joined = joined.select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b")
    joined = joined.where("a <> b")
    return joined if large else joined.distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether each node above another has one edge, to a node that is above none: all stars."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("b", F.lit(0), F.lit(1)))
    found = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return found.where("up > 1 or up + down > 1").agg(F.count("*")).first()[0] == 0


def components(links: DataFrame, most: int | None = None) -> DataFrame:
    """(node, component) for every node of the links (a, b); component is its smallest node.

    Links to itself are ignored; repeated links and both directions are one link.  Each
    round is written to the shared folder; rounds grow with the logarithm of a component's
    width.  ``most`` is a bound of the number of links, if one is known.
    """
    edges = stored(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), most)
    while not _settled(edges):
        # Star steps never leave more edges than there were.
        edges = stored(_star(_star(edges, True), False), most)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
