"""Size against headcount by sector: robust bands from the sectors' own quartiles.

A ratio is out of band if it lies more than ``SPREAD`` interquartile ranges beyond the
quartiles of its group. Quartiles come in two forms. The exact one reduces rows to (group,
value, frequency) before a frequency-weighted percentile, so that a group's state is its
distinct values. The sketch (``accuracy`` given) keeps a mergeable summary per group and task,
of a size that depends on the accuracy alone; a quantile's rank is off by at most rows / accuracy.

Rows meet their band in a join by group; the side of the bands has a row per group, and the
engine broadcasts it only if it measures it as small. Rows without a group share one band;
rows without a ratio (null, or no positive headcount) are in no band and violate none.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPREAD = 1.0
QUARTILES = (0.25, 0.5, 0.75)
ACCURACY = 200


def per_head(size: str, heads: str) -> Column:
    return F.when(F.col(heads) > 0, F.col(size).cast("double") / F.col(heads))


def quartiles(df: DataFrame, group: str, ratio: Column, accuracy: int | None = None) -> DataFrame:
    """``(band_group, ratio_rows, q)``: the quartiles of ``ratio`` in each group, as an array."""
    rows = df.select(F.col(group).alias("band_group"), ratio.alias("_ratio")).filter(F.col("_ratio").isNotNull())
    at = F.array(*[F.lit(q) for q in QUARTILES])
    if accuracy is not None:
        return rows.groupBy("band_group").agg(
            F.count(F.lit(1)).alias("ratio_rows"), F.percentile_approx("_ratio", at, F.lit(accuracy)).alias("q"))
    return rows.groupBy("band_group", "_ratio").agg(F.count(F.lit(1)).alias("_rows")).groupBy("band_group").agg(
        F.sum("_rows").alias("ratio_rows"), F.percentile("_ratio", at, F.col("_rows")).alias("q"))


def with_band(df: DataFrame, group: str, ratio: Column, accuracy: int | None = None, spread: float = SPREAD) -> DataFrame:
    """``df`` with ``band_side``: -1 below its group's band, 1 above it, 0 within, null without a ratio."""
    q = quartiles(df, group, ratio, accuracy).withColumn("_reach", spread * (F.get("q", F.lit(2)) - F.get("q", F.lit(0))))
    bands = q.select("band_group", (F.get("q", F.lit(0)) - F.col("_reach")).alias("_low"),
                     (F.get("q", F.lit(2)) + F.col("_reach")).alias("_high"))
    side = F.when(ratio < F.col("_low"), -1).when(ratio > F.col("_high"), 1).when(ratio.isNotNull(), 0)
    joined = df.join(bands, F.col(group).eqNullSafe(F.col("band_group")), "left")
    return joined.withColumn("band_side", side).drop("band_group", "_low", "_high")


def sides_by_group(df: DataFrame, group: str, ratio: Column, accuracy: int | None = None) -> DataFrame:
    banded = with_band(df, group, ratio, accuracy)
    return banded.groupBy(group).agg(
        F.count("band_side").alias("rows_with_ratio"), F.count_if(F.col("band_side") < 0).alias("below"),
        F.count_if(F.col("band_side") > 0).alias("above"))


def sketch_ranks(df: DataFrame, group: str, ratio: Column, accuracy: int = ACCURACY) -> DataFrame:
    """Per group: its rows with a ratio, and whether every sketched quartile has a rank within the
    stated error of the exact one (rows / accuracy, and one row for rounding)."""
    sketch = quartiles(df, group, ratio, accuracy)
    rows = df.select(F.col(group).alias("_group"), ratio.alias("_ratio")).filter(F.col("_ratio").isNotNull())
    met = rows.join(sketch, F.col("_group").eqNullSafe(F.col("band_group")))
    value = [F.get("q", F.lit(i)) for i in range(len(QUARTILES))]
    counts = met.groupBy("_group").agg(
        F.count(F.lit(1)).alias("rows_with_ratio"),
        *[F.count_if(F.col("_ratio") < v).alias(f"_below{i}") for i, v in enumerate(value)],
        *[F.count_if(F.col("_ratio") <= v).alias(f"_upto{i}") for i, v in enumerate(value)])
    n = F.col("rows_with_ratio")
    within = F.lit(True)
    for i, p in enumerate(QUARTILES):
        within = within & (F.col(f"_below{i}") <= n * (p + 1 / accuracy) + 1) & (F.col(f"_upto{i}") >= n * (p - 1 / accuracy) - 1)
    return counts.select(F.col("_group").alias(group), "rows_with_ratio", within.alias("within_error"))
