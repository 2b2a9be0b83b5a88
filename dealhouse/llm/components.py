"""Connected components of an edge table by alternating large-star / small-star
rounds (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014).

Every round is two aggregates (minimum neighbour, combined before the shuffle) and
two equi-joins with a side that is unique by node, so a hub with many neighbours is
split by the join's skew handling. No node list ever reaches the driver.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealhouse.llm.common import materialize


def _hang_from_least(edges: DataFrame, least: DataFrame, larger_only: bool) -> DataFrame:
    """Hang neighbours ``v`` of every ``u`` from the least node around ``u``."""
    joined = edges.join(least, "u")
    if larger_only:
        joined = joined.filter("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")


def _state(edges: DataFrame) -> tuple:
    """What tells one edge set from another: its size and an order-free hash sum."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, a: str, b: str, label: str = "components") -> DataFrame:
    """``(node, root)`` for every node of ``links``; root is the smallest node reachable.

    Rows with a null end and loops are ignored; repeated links count once; an empty
    table gives an empty table.
    """
    edges = materialize(
        links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        label)
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _hang_from_least(both, least, larger_only=True).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _hang_from_least(large, least, larger_only=False).unionByName(
            least.select("u", F.col("m").alias("v")))
        edges = materialize(small.distinct(), label)
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
