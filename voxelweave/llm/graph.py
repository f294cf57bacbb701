"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelweave.llm.common import written


def _hop(parents: DataFrame) -> DataFrame:
    """Replace each node's parent by its parent's parent."""
    up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("next"))
    return parents.join(up, "parent", "left").select("node", F.coalesce("next", "parent").alias("parent"))


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (a, b)``; nodes of one component share one root, a node of theirs.

    Each round every node points to the neighbour (or itself) of the lowest random rank, drawn anew per round so
    that no ordering of ids makes long chains; two hops shorten the paths and links are contracted to the parents. At
    least half of the nodes of a component vanish per round in expectation, so the number of rounds is logarithmic. Neighbour
    minima are combined before the shuffle, and joins meet one row per node, so a node with very many links can be
    split by adaptive execution. Every round is a written table; loops and repeated links are harmless.
    """
    edges = written(links.where("a <> b").select("a", "b").distinct(), "links")
    rounds = []
    while not edges.isEmpty():
        rank = F.lit(len(rounds))
        both = edges.union(edges.select("b", "a"))
        best = F.min(F.struct(F.xxhash64("b", rank).alias("rank"), F.col("b").alias("node"))).alias("best")
        own = F.struct(F.xxhash64("a", rank).alias("rank"), F.col("a").alias("node"))
        nearest = both.groupBy("a").agg(best).select(F.col("a").alias("node"), F.least(own, "best")["node"].alias("parent"))
        parents = written(_hop(_hop(written(nearest, "nearest"))), "parents")
        rounds.append(parents)
        ends = [parents.select(F.col("node").alias(c), F.col("parent").alias(f"{c}_up")) for c in "ab"]
        moved = edges.join(ends[0], "a").join(ends[1], "b")
        low, high = F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b")
        edges = written(moved.where("a_up <> b_up").select(low, high).distinct(), "links")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = rounds[0].withColumnRenamed("parent", "root")
    for parents in rounds[1:]:
        up = parents.select(F.col("node").alias("root"), F.col("parent").alias("next"))
        roots = roots.join(up, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return roots
