"""Connected components of an edge table with DataFrame operations alone.

In each round every node points to the least of itself and its neighbours in an
order that is drawn anew, pointers are followed once more, and the edges are
rewritten to what their ends point to. The order by chance makes the nodes that
are left a fraction of those before, also on long chains. A hub meets its
neighbours only as a minimum, which is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.sources.paths import stored


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node`` and ``component``, the least node it is connected to, for each node of the edges.

    Rows with a NULL end are left out; loops make a node of its own; repeated
    edges count once. An edge table without rows gives no row.
    """
    ends = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    now = stored(ends.where(F.col("a") != F.col("b")).distinct(), "edges")
    nodes = ends.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = stored(nodes.select("node", F.col("node").alias("root")), "labels")
    turn = 0
    while not now.isEmpty():
        both = now.select("a", "b").union(now.select("b", "a"))

        def ranked(name: str, turn: int = turn) -> Column:
            return F.struct(F.xxhash64(F.col(name), F.lit(turn)).alias("h"), F.col(name).alias("to"))

        least = both.groupBy("a").agg(F.least(F.min(ranked("b")), F.min(ranked("a"))).alias("least"))
        step = stored(least.select("a", F.col("least.to").alias("b")), "pointers")
        # A node pointed to may itself point on.
        jump = stored(
            step.join(step.select(F.col("a").alias("b"), F.col("b").alias("c")), "b", "left").select(
                F.col("a").alias("from"), F.coalesce("c", "b").alias("to")
            ),
            "pointers",
        )
        labels = stored(
            labels.join(jump, labels["root"] == jump["from"], "left").select("node", F.coalesce("to", "root").alias("root")), "labels"
        )
        moved = (
            now.join(jump.select(F.col("from").alias("a"), F.col("to").alias("x")), "a")
            .join(jump.select(F.col("from").alias("b"), F.col("to").alias("y")), "b")
            .where(F.col("x") != F.col("y"))
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        )
        now = stored(moved.distinct(), "edges")
        turn += 1
    least_node = labels.groupBy("root").agg(F.min("node").alias("component"))
    return labels.join(least_node, "root").select("node", "component")
