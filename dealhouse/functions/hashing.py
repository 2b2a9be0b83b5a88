"""Row content hashes used to gate SCD1 updates.

The hash is MD5 over the ``'||'``-joined canonical text of the attributes,
NULL rendered as ''. Canonical text is engine-independent: doubles are printed
through DECIMAL(38,6) (so 1e7 hashes as '10000000.000000' rather than '1.0E7'),
dates as ISO 'YYYY-MM-DD', integers and decimals in plain notation.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_SEPARATOR = "||"


def canonical_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return c.try_cast("decimal(38,6)").cast("string")
    return c.cast("string")


def content_hash(df: DataFrame, columns: list[str]) -> Column:
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = [F.coalesce(canonical_text(F.col(c), types[c]), F.lit("")) for c in columns]
    return F.md5(F.concat_ws(HASH_SEPARATOR, *parts))
