"""Table maintenance operators: SCD1 upsert, partition replace, column evolution.

``scd1_merge`` is a pure function ``(current, source) -> next version``: one
full outer join on the key (null-safe, so a NULL key matches itself instead
of piling up a new row per run), then a per-row pick. Source rows win when
the key is new or the content hash differs; otherwise the current row is kept
whole, stamps included. Keys missing from the source are kept (no deletes).
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class DuplicateKeyError(ValueError):
    pass


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add every column of ``schema`` that ``df`` lacks, as typed NULLs."""
    missing = [f for f in schema.fields if f.name not in df.columns]
    if not missing:
        return df
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


def ensure_column(df: DataFrame, name: str, dtype: T.DataType | str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(dtype))


def repeats_keys(df: DataFrame, keys: Sequence[str]) -> bool:
    dupes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return bool(dupes.limit(1).count())


def assert_unique_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Fail before merging when a key repeats (a join would silently duplicate)."""
    if repeats_keys(df, keys):
        raise DuplicateKeyError(f"source repeats key {list(keys)}")


def rows_to_upsert(current: DataFrame, source: DataFrame, keys: Sequence[str],
                   hash_column: str | None = "row_content_hash") -> DataFrame:
    """The rows of ``source`` whose key is new or whose hash differs; of ``current`` only keys and hashes are read."""
    compared = [*keys, *([hash_column] if hash_column else [])]
    if not hash_column:
        return source
    held = current.select(*[F.col(c).alias(f"t__{c}") for c in compared])
    same = reduce(lambda a, b: a & b, [F.col(f"t__{c}").eqNullSafe(F.col(c)) for c in compared])
    return source.join(held, same, "left_anti")


def scd1_merge(current: DataFrame | None, source: DataFrame, keys: Sequence[str],
               columns: Sequence[str], hash_column: str | None = "row_content_hash",
               check_unique: bool = True) -> DataFrame:
    """The next version of ``current`` after upserting ``source``.

    A first load (no ``current``) takes the source as it is, repeated keys included, so that
    downstream checks can report them; an upsert from a source that repeats a key raises.
    ``source`` is read twice (uniqueness, merge): hand in a written table."""
    src = source.select(*columns)
    if current is None:
        return src
    if check_unique:
        assert_unique_keys(src, keys)
    cur = ensure_columns(current, src.schema).select(*columns)
    t = cur.select(*[F.col(c).alias(f"t__{c}") for c in columns], F.lit(True).alias("t__present"))
    s = src.select(*[F.col(c).alias(f"s__{c}") for c in columns], F.lit(True).alias("s__present"))
    on = reduce(lambda a, b: a & b, [F.col(f"t__{k}").eqNullSafe(F.col(f"s__{k}")) for k in keys])
    j = t.join(s, on, "full_outer")
    in_source = F.col("s__present").isNotNull()
    in_target = F.col("t__present").isNotNull()
    take_source: Column = in_source & ~in_target
    if hash_column and hash_column in columns:
        changed = ~F.col(f"t__{hash_column}").eqNullSafe(F.col(f"s__{hash_column}"))
        take_source = take_source | (in_source & in_target & changed)
    else:
        take_source = in_source
    return j.select(*[
        F.when(take_source, F.col(f"s__{c}")).otherwise(F.col(f"t__{c}")).alias(c) for c in columns
    ])
