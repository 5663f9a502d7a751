"""Connected components of an edge table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a long, b long); a component is named by its smallest node.

    In a round each node points to its smallest neighbour, pointers are
    followed twice, and edges are drawn anew between what they point to; edges
    within one component vanish.  A round at least halves the nodes that still
    have edges, so the rounds are few, and each ends in a written table.
    """
    left = written(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    nodes = left.select(F.col("a").alias("node")).unionAll(left.select(F.col("b").alias("node"))).distinct()
    found = written(nodes.select("node", F.col("node").alias("component")), "nodes")
    while not left.isEmpty():
        both = left.unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = written(both.groupBy("a").agg(F.min("b").alias("to")).select("a", F.least("a", "to").alias("to")), "points")
        for _ in range(2):
            on = point.select(F.col("a").alias("to"), F.col("to").alias("next"))
            point = written(point.join(on, "to").select("a", F.col("next").alias("to")), "points")
        to_a, to_b = point.select("a", F.col("to").alias("ta")), point.select(F.col("a").alias("b"), F.col("to").alias("tb"))
        left = written(left.join(to_a, "a").join(to_b, "b").filter("ta <> tb")
                       .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "edges")
        moved = point.select(F.col("a").alias("component"), "to")
        found = written(found.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "nodes")
    # pointers go to smaller nodes only, so a component ends at its smallest
    return found
