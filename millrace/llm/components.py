"""Connected components of a link table, all on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import stash


def roots(up: DataFrame) -> DataFrame:
    """(node, root) of a forest (node, root) whose trees are walked by doubling, so that each node names its tree's root."""
    while True:
        inner = up.where("node != root").select(F.col("node").alias("via"), F.col("root").alias("next"))
        jumped = up.join(inner, up.root == inner.via, "left").select("node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        up = stash(jumped, "forest")
        if up.where("moved").isEmpty():
            return up.select("node", "root")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for each node of ``links`` (a, b).

    Each round contracts: a node hangs on the neighbour that a hash ranks lowest, if it ranks below the node itself; trees
    become one node each and links between trees go on to the next round. At most half of the nodes that still have links are roots, so
    the links left fall fast. Every round is written to the shared folder, which ends its lineage.
    """
    edges = stash(links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    found, turn = None, 0
    while found is None or not edges.isEmpty():
        rank = lambda c, turn=turn: F.struct(F.xxhash64(F.col(c), F.lit(turn)), F.col(c))
        both = edges.union(edges.select("b", "a"))
        lowest = both.groupBy("a").agg(F.min(rank("b")).alias("low"))
        own = lowest.select(F.col("a").alias("node"), F.when(F.col("low") < rank("a"), F.col("low.b")).otherwise(F.col("a")).alias("root"))
        up = roots(own)
        ends = edges.join(up.select(F.col("node").alias("a"), F.col("root").alias("x")), "a").join(up.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
        edges = stash(ends.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        if found is None:
            found = up
        else:
            higher = up.select(F.col("node").alias("via"), F.col("root").alias("next"))
            found = stash(found.join(higher, found.root == higher.via, "left").select("node", F.coalesce("next", "root").alias("root")), "found")
        turn += 1
    least = found.groupBy("root").agg(F.min("node").alias("label"))
    return stash(found.join(least, "root").select("node", "label"), "labels")


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after further ``links`` (a, b); only links between different labels cost anything."""
    one, two = labels.select(F.col("node").alias("a"), F.col("label").alias("x")), labels.select(F.col("node").alias("b"), F.col("label").alias("y"))
    ends = links.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
    moved = components(ends).withColumnsRenamed({"node": "via", "label": "next"})
    grown = labels.join(moved, labels.label == moved.via, "left").select("node", F.coalesce("next", "label").alias("label"))
    fresh = moved.join(labels.select("node"), moved.via == labels.node, "left_anti").select(F.col("via").alias("node"), F.col("next").alias("label"))
    return stash(grown.union(fresh), "labels")
