"""Connected components of an edge table by alternating star contraction.

Each round is a handful of aggregations and joins on the edges that are left; nothing is
collected. Rounds are written to the shared folder, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_groups, shared_table


def _minima(edges: DataFrame, n: int) -> DataFrame:
    """Edges ``(u, v)``, both directions given, with ``m``: the least of u and its neighbours.

    A node with very many edges is joined by broadcast, see ``join_groups``.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("_least"), F.count(F.lit(1)).alias("_degree"))
    return join_groups(edges, least, "u", "_degree", n).withColumn("m", F.least("u", "_least"))


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; component = smallest node.

    Large-star joins every larger neighbour of a node to the least node around it,
    small-star joins a node and its smaller neighbours to the least of them. Both keep
    the components; at the fixed point every component is a star around its least node.
    An empty edge table gives an empty result. The number of rounds grows with the
    logarithm of the longest path; running out of rounds raises.
    """
    pairs = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = shared_table(pairs.distinct(), "components-0")
    for k in range(1, max_rounds + 1):
        n = now.count()
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = shared_table(_minima(both, 2 * n).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), f"components-{k}l")
        # small-star: u > v in every row of ``large``; the least neighbour takes the others and u
        small = _minima(large, large.count())
        after = shared_table(
            small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v"))).distinct(), f"components-{k}")
        sums = [t.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() for t in (now, after)]
        now = after
        if sums[0] == sums[1]:
            members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return members.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
