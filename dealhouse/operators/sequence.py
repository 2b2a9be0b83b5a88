"""Ordered numbering and previous-row values per group, without a group in one task.

``Window.partitionBy(g).orderBy(...)`` sends every row of a group to one task. Here rows
are dealt into slices that follow one another in the order, each slice is numbered by
itself, and a summary per slice (its rows and its last row) gives the offset to add and the
values to carry over from the slice before. The result
equals ``row_number()`` / ``lag(1)`` over the plain window, at every group size, by one path.

A slice is (group, first order key, bucket). Buckets cut what agrees in group and first key by
the second order key: its leading ``prefix`` characters, which order the same way as the whole
text does. Summaries are themselves a sequence and are carried over level by level: bucket to
bucket within a (group, first key), then first key to first key within the group. Slices are a
function of the row's own values, nothing is sampled, so both reads of the input agree whatever
columns they keep.

Rows meet in one task only if they agree in group, first key and the leading characters of the
second. A window over summaries sees a row per bucket of one (group, first key), or a row per
first key of one group.

Slices of a row or two make summaries as many as the rows. ``sequence_parts`` therefore numbers
groups of at most ``small`` rows each by one plain window, and only larger ones by slices. It reads
its input once more, to count: hand in a written table.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX = 10
# Rows of one group that a task may well take together.
SMALL = 50_000


def by_size(df: DataFrame, group: str, small: int = SMALL) -> tuple[DataFrame, DataFrame]:
    """The rows of groups of at most ``small`` rows, and those of all others and of the NULL group."""
    sizes = df.groupBy(F.col(group).alias("_z_group")).agg(F.count(F.lit(1)).alias("_z_rows"))
    # One row for each ``small`` rows of the input at most.
    large = F.broadcast(sizes.filter((F.col("_z_rows") > small) | F.col("_z_group").isNull()).select("_z_group"))
    few = df.filter(F.col(group).isNotNull()).join(large, F.col(group) == F.col("_z_group"), "left_anti")
    return few, df.join(large, F.col(group).eqNullSafe(F.col("_z_group")), "left_semi")


def _ascending(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def _rank(columns: Sequence[str]) -> Column:
    """A value that compares as the columns do; NULLs last, so a flag goes before each value."""
    return F.struct(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))]) if columns else F.lit(0)


def _bucket(df: DataFrame, rest: Sequence[str], prefix: int) -> Column:
    """The part of the second order key that slices are cut by; one bucket if it is no text."""
    if rest and isinstance(df.schema[rest[0]].dataType, T.StringType):
        return F.substring(rest[0], 1, prefix)
    return F.lit(None).cast("string")


def _carried(summaries: DataFrame, over: Sequence[str], key: str, rows: str, last: str, name: str) -> DataFrame:
    """``summaries`` with what comes before each of them within ``over``, in the order of ``key``."""
    across = Window.partitionBy(*over).orderBy(F.col(key).asc_nulls_last())
    return summaries.withColumns({
        f"_s_{name}_rows": F.coalesce(
            F.sum(rows).over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        f"_s_{name}_last": F.lag(last).over(across)})


def _plain(df: DataFrame, group: str, order: Sequence[str], lag_columns: Sequence[str], rn_name: str,
           prior_prefix: str) -> DataFrame:
    whole = Window.partitionBy(group).orderBy(*_ascending(order))
    return df.select(*df.columns, F.row_number().over(whole).cast("bigint").alias(rn_name),
                     *[F.lag(c).over(whole).alias(f"{prior_prefix}{c}") for c in lag_columns])


def sequence_parts(df: DataFrame, group: str, order: Sequence[str], lag_columns: Sequence[str], rn_name: str,
                   prior_prefix: str = "prior_", prefix: int = PREFIX, small: int = SMALL) -> tuple[DataFrame, DataFrame]:
    """``sequence_with_prior`` in two parts: groups of at most ``small`` rows, which lie by ``group``, and others."""
    few, many = by_size(df, group, small)
    return (_plain(few, group, order, lag_columns, rn_name, prior_prefix),
            sequence_with_prior(many, group, order, lag_columns, rn_name, prior_prefix, prefix))


def sequence_with_prior(df: DataFrame, group: str, order: Sequence[str], lag_columns: Sequence[str],
                        rn_name: str, prior_prefix: str = "prior_", prefix: int = PREFIX) -> DataFrame:
    """Add ``rn_name`` (1-based order within ``group``) and ``prior_<c>`` for each of
    ``lag_columns`` (value on the previous row of the same group).

    ``order``: columns, all ascending with NULLs last; together they should tell rows apart.
    ``group`` must not be NULL (filter such rows first). ``prefix``: characters of the second
    order key that buckets are cut by; it decides how finely rows of one group and first key are
    spread and leaves the result as it is."""
    slice_key, rest = order[0], order[1:]
    bucketed = df.withColumn("_s_bucket", _bucket(df, rest, prefix))
    within = Window.partitionBy(group, slice_key, "_s_bucket").orderBy(*(_ascending(rest) or [F.lit(0)]))
    # A slice's last row, which has no next one, tells its rows and what it hands on.
    buckets = bucketed.withColumns({
        "_s_rows": F.row_number().over(within).cast("bigint"), "_s_next": F.lead(F.lit(1)).over(within),
    }).filter("_s_next IS NULL").select(
        F.col(group).alias("_s_group"), F.col(slice_key).alias("_s_key"), F.col("_s_bucket").alias("_s_cut"),
        "_s_rows", F.struct(*lag_columns).alias("_s_end"))
    keys = buckets.groupBy("_s_group", "_s_key").agg(
        F.sum("_s_rows").alias("_s_key_rows"),
        F.max_by("_s_end", _rank(["_s_cut"])).alias("_s_key_end"))
    by_key = _carried(keys, ["_s_group"], "_s_key", "_s_key_rows", "_s_key_end", "outer").select(
        F.col("_s_group").alias("_k_group"), F.col("_s_key").alias("_k_key"), "_s_outer_rows", "_s_outer_last")
    by_bucket = _carried(buckets, ["_s_group", "_s_key"], "_s_cut", "_s_rows", "_s_end", "inner")
    before = by_bucket.join(
        by_key, (F.col("_s_group") == F.col("_k_group")) & F.col("_s_key").eqNullSafe(F.col("_k_key"))
    ).select("_s_group", "_s_key", "_s_cut", (F.col("_s_outer_rows") + F.col("_s_inner_rows")).alias("_s_offset"),
             F.coalesce("_s_inner_last", "_s_outer_last").alias("_s_carry"))
    numbered = bucketed.withColumns({
        "_s_local": F.row_number().over(within),
        **{f"_s_lag_{c}": F.lag(c).over(within) for c in lag_columns}})
    joined = numbered.join(
        before, (F.col(group) == F.col("_s_group")) & F.col(slice_key).eqNullSafe(F.col("_s_key"))
        & F.col("_s_bucket").eqNullSafe(F.col("_s_cut")), "left")
    first = F.col("_s_local") == 1
    return joined.select(
        *df.columns,
        (F.col("_s_local") + F.col("_s_offset")).cast("bigint").alias(rn_name),
        *[F.when(first, F.col("_s_carry")[c]).otherwise(F.col(f"_s_lag_{c}")).alias(f"{prior_prefix}{c}")
          for c in lag_columns])
