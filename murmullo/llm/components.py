"""Connected components of an undirected graph, by alternating star operations.

Both steps group by a node, whose smallest neighbour is a partial aggregate, and
send every neighbour to it; no list of neighbours is ever built. A round
that changes nothing ends the loop; each round is written, so the lineage stays
short and lost executors repeat one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmullo.llm.common import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _to_smallest(links: DataFrame, larger_only: bool) -> DataFrame:
    """Link the neighbours ``b`` of each ``a`` to the smallest of them and ``a``."""
    smallest = links.groupBy("a").agg(F.min("b").alias("_m")).select(
        F.col("a").alias("_a"), F.least("a", "_m").alias("_m")
    )
    met = links.join(smallest, F.col("a") == F.col("_a"))
    if larger_only:
        met = met.filter("b > a")
    else:
        # The node itself goes to the smallest as well.
        met = met.select("a", F.explode(F.array("a", "b")).alias("b"), "_m")
    return met.filter("b != _m").select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node that has an edge; the root is the smallest node.

    ``edges`` has two columns ``a`` and ``b`` of one type. Loops and repeated
    edges are allowed; without edges the result is empty.
    """
    now = stage(edges.filter("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct(), "components")
    before = None
    while True:
        large = _to_smallest(_both_ways(now), larger_only=True)
        # From larger to smaller only: `a` is the larger end of each edge.
        now = stage(_to_smallest(large, larger_only=False), "components")
        state = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
