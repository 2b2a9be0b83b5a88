"""Positions of rows within their groups, at any group size.

A window over a group would put a hot group into one task. Here the rows are sorted into
ranges of (group, order) over all partitions, a range counts its rows by group, and the
counts of the ranges before it give each row its position.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealhouse.llm.common import materialize

PART_BITS = 33  # monotonically_increasing_id: the partition above, the row below these bits


def positions(rows: DataFrame, group: list[str], order: list[str], label: str = "positions") -> DataFrame:
    """``rows`` with ``pos``, the 0-based rank in ``group`` by ``order``, and ``n``, the group's rows.

    Nulls come first and are a group of their own. Rows that are equal in all of ``order`` are
    told apart by where they were read, so no run of equal rows is kept together. The sorted
    rows are written once: what a range holds is settled before it is counted. ``rows`` should
    be a written table, as ranges are chosen from a sample that reads it beforehand.
    """
    keys = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    dealt = materialize(
        rows.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id()), label)
    dealt = dealt.withColumn("_part", F.shiftright("_at", PART_BITS))
    ranges = dealt.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    # A group has a row for each range it reaches into, the number of partitions at most.
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        *(F.col(c).alias(f"_g{i}") for i, c in enumerate(group)), F.col("_part").alias("_p"), "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.sum("_rows").over(whole).alias("n"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)],
                  F.col("_part") == F.col("_p"))
    return dealt.join(ranges, same).select(
        *rows.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias("pos"), "n")
