"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""
from dealhouse.functions.casts import date_or_null, double_or_null, int_or_null
from dealhouse.functions.hashing import canonical_text, content_hash
from dealhouse.functions.measures import (
    deal_size_tier,
    pct_vs_benchmark,
)
from dealhouse.functions.text import clean_str, is_blank, norm_id

__all__ = [
    "canonical_text",
    "clean_str",
    "content_hash",
    "date_or_null",
    "deal_size_tier",
    "double_or_null",
    "int_or_null",
    "is_blank",
    "norm_id",
    "pct_vs_benchmark",
]
