"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``v, label`` for every end of ``edges(a, b)``; label is the smallest end reachable.

    Each round points every vertex to its smallest neighbour, follows the
    pointers one step further, and draws the vertices that point to one another
    together: what is left are the edges between them, several times fewer in
    every round.  It ends when none is left.  Rounds are written tables, all
    joins and sums are keyed and split, nothing is collected.
    """
    given = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a is not null").distinct(), "edges")
    ends = given.select(F.col("a").alias("v")).union(given.select("b")).distinct()
    edges = given.where("a < b")
    labels = stored(ends.select("v", F.col("v").alias("label")), "labels")
    while not edges.isEmpty():
        near = edges.union(edges.select("b", "a")).groupBy("a").agg(F.min("b").alias("near"))
        to = near.select("a", F.least("a", "near").alias("root"))
        onward = to.select(F.col("a").alias("mid"), F.col("root").alias("far"))
        to = stored(to.join(onward, to.root == onward.mid).select("a", F.col("far").alias("root")), "pointers")
        first, second = to.select(F.col("a").alias("from_a"), F.col("root").alias("to_a")), to.select(F.col("a").alias("from_b"), F.col("root").alias("to_b"))
        moved = edges.join(first, edges.a == first.from_a).join(second, edges.b == second.from_b)
        edges = stored(moved.where("to_a <> to_b").select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges")
        labels = stored(labels.join(to, labels.label == to.a, "left").select("v", F.coalesce("root", "label").alias("label")), "labels")
    return labels
