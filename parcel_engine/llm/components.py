"""Connected components of an undirected graph by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel_engine.llm.common import discard, staged


def components(edges: DataFrame, scale: int | None = None) -> DataFrame:
    """(node, component): the smallest node that can be reached, for nodes that have an edge.

    Columns ``a`` and ``b``, any direction, loops and repetitions allowed; no null ends. Each
    round replaces a node's links by links to its smallest neighbour; a node's neighbours are
    never gathered, only their minimum. Rounds are logarithmic in the longest path. ``scale``: of
    the nodes, see ``staged``.
    """
    ends = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    now = staged(ends, "edges", scale=scale)
    while True:
        # large star: every larger neighbour of a node goes to the node's smallest one
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.where("b > a").join(least, "a").select(F.col("least").alias("a"), "b").where("a <> b")
        # small star: the smaller neighbours of a node, and itself, go to the smallest of them
        least = large.groupBy("b").agg(F.min("a").alias("least"))
        small = (
            large.join(least, "b")
            .select(F.explode(F.array("a", "b")).alias("b"), F.col("least").alias("a"))
            .where("a <> b")
            .select("a", "b")
            .distinct()
        )
        after = staged(small, "edges", scale=scale)
        # done when every node hangs on one root: no root has a parent, no node two
        many = after.groupBy("b").agg(F.count("*").alias("n")).where("n > 1").select("b")
        deep = after.select("b").join(after.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        done = many.union(deep).isEmpty()
        discard(now)
        if done:
            break
        now = after
    roots = after.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    out = after.select(F.col("b").alias("node"), F.col("a").alias("component")).union(roots)
    out.staged_in = after.staged_in
    return out
