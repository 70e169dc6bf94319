"""Linking members of shared bands without expanding groups into their pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import steps, stored
from .components import components


def shared_members(rows: DataFrame) -> DataFrame:
    """The rows (band, node) whose band has several of them, with their number ``n``."""
    shared = rows.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    return stored(rows.join(shared, "band"))


def _open(members: DataFrame, parts: DataFrame, rows: int) -> DataFrame:
    """(band, node, component, weight) of the bands whose members are in several components."""
    placed = members.select("band", "node").join(parts, "node")
    several = placed.groupBy("band").agg(
        F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return stored(placed.join(several.select("band"), "band", "left_semi"), rows)


def _merged(parts: DataFrame, links: DataFrame, size: int) -> DataFrame:
    """The components (node, component, weight) after links between nodes.

    Only the components that the links join are contracted, over one link per pair of them.
    """
    with steps(parts.sparkSession) as keep:
        of = parts.select("node", "component")
        pairs = links.join(of.toDF("a", "one"), "a").join(of.toDF("b", "two"), "b").select(
            F.col("one").alias("a"), F.col("two").alias("b"))
        roots = components(pairs, size).toDF("component", "root")
        weights = parts.select("component", "weight").distinct().join(roots, "component")
        total = weights.groupBy("root").agg(F.sum("weight").alias("total"))
        moved = roots.join(total, "root")
        return keep(parts.join(moved, "component", "left").select(
            "node", F.coalesce("root", "component").alias("component"),
            F.coalesce("total", "weight").alias("weight")), size)


def link_components(
    members: DataFrame, sides: DataFrame, distance: Callable[[Callable, Callable], Column],
    most: int, accept: Callable[[DataFrame], DataFrame], rounds: int = 4,
    possible: Callable[[Callable, Callable], Column] | None = None,
) -> DataFrame:
    """(node, component) of the nodes that share a band.

    ``sides`` has columns of each node; ``distance`` makes of them, for the two sides of a
    pair, an estimate of how far apart they are, which is up to ``most`` for all that are worth
    a closer look; ``accept`` keeps the true pairs (a, b).  ``possible`` is true for all pairs
    that ``accept`` may keep: a bound that loses none, for columns only the last step reads.

    In a round every node has one try: of the hubs of its bands, the nearest within ``most``.
    A band's hub is a member of its heaviest component (weights are summed from the sizes of
    shared bands), in turn its most popular one and any.  What is accepted is one link for
    each node at most; components are merged by it before the next round.  A band whose members
    are in one component is closed and its rows are left out from then on; when none is open,
    that is all.  After the rounds all pairs within ``most`` across the components of the open
    bands are tried once each, if they are ``possible``.  So every such pair that shares a band
    is linked, found to be no link, or already connected, while a group of copies costs one pair
    for each member.  What ``accept`` stores is removed after its pairs are
    written.
    """
    names = [c for c in sides.columns if c != "node"]
    one, two = sides.toDF(*[f"a_{c}" for c in sides.columns]), sides.toDF(
        *[f"b_{c}" for c in sides.columns])
    far = distance(lambda c: F.col(f"a_{c}"), lambda c: F.col(f"b_{c}"))
    popular = stored(members.groupBy("node").agg(F.sum("n").alias("popularity")))
    # What is written below has a row for each node, or for each member, at most.
    size, rows = popular.count(), members.count()
    parts = popular.select("node", F.col("node").alias("component"), F.col("popularity").alias("weight"))
    tried = None
    if not rows:
        return parts.select("node", "component")
    for turn in range(rounds):
        # At first every node is a component, so every shared band is open.
        if turn:
            members = placed = _open(members, parts, rows)
            if members.isEmpty():
                return parts.select("node", "component")
        else:
            placed = members.drop("n").join(parts, "node")
        likely = F.xxhash64("node", F.lit(turn)) if turn % 2 else F.col("popularity")
        hubs = placed.join(popular, "node").groupBy("band").agg(F.max_by(
            F.struct("node", "component"), F.struct("weight", likely, -F.col("node"))).alias("hub"))
        choices = placed.join(hubs, "band").where("component <> hub.component").select(
            F.col("node").alias("a"), F.col("hub.node").alias("b")).distinct()
        if tried is not None:
            choices = choices.join(tried, ["a", "b"], "left_anti")
        near = choices.join(one, F.col("a") == F.col("a_node")).join(
            two, F.col("b") == F.col("b_node")).select("a", "b", far.alias("far")).where(F.col("far") <= most)
        pairs = stored(near.groupBy("a").agg(F.min_by("b", F.struct("far", "b")).alias("b")), size)
        tried = pairs if tried is None else tried.union(pairs)
        with steps(members.sparkSession) as keep:
            links = keep(accept(pairs).distinct(), size)
        if not links.isEmpty():
            parts = _merged(parts, links, size)
    members = _open(members, parts, rows)
    if members.isEmpty():
        return parts.select("node", "component")
    # A pair that passes in several bands is one; rows carry no list of their bands for that.
    ends = members.select("node", "band", "component").join(sides, "node")
    x = ends.toDF("a", "band", "ca", *[f"a_{c}" for c in names])
    y = ends.toDF("b", "band", "cb", *[f"b_{c}" for c in names])
    worth = F.lit(True) if possible is None else possible(
        lambda c: F.col(f"a_{c}"), lambda c: F.col(f"b_{c}"))
    across = x.join(y, "band").where(
        (F.col("ca") < F.col("cb")) & (far <= most) & worth).select("a", "b").distinct()
    with steps(members.sparkSession) as keep:
        links = keep(accept(across).distinct())
    parts = parts if links.isEmpty() else _merged(parts, links, max(size, links.count()))
    return parts.select("node", "component")
