"""Derived measures and deterministic aggregates.

Floating-point SUM/AVG depend on the order rows are combined in, which changes
with partitioning, retries and AQE coalescing; a re-run could then flip a
rollup hash with no data change. ``fixed_sum`` therefore adds values as
DECIMAL(38,6) (exact, order-independent) and returns a double.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dealhouse.functions.text import _col

FIXED_POINT = "decimal(38,6)"

# Deal size tiers in $MM (upper bounds are exclusive).
SIZE_TIERS = ((100, "Small"), (500, "Mid-Market"), (2000, "Large"))
TOP_TIER = "Mega"
# A benchmark closer to zero than this is treated as missing.
BENCHMARK_EPSILON = 1e-9


def fixed_sum_exact(c) -> Column:
    """SUM as DECIMAL(38,6); use for re-aggregation of partial sums."""
    return F.sum(_col(c).cast(FIXED_POINT))


def avg_from_parts(sum_dec: Column, n: Column) -> Column:
    """AVG from an exact decimal sum and a non-null count."""
    return F.when(n > 0, sum_dec.cast("double") / n)


def deal_size_tier(c) -> Column:
    x = _col(c)
    expr = F.when(x.isNull(), F.lit(None).cast("string"))
    for bound, label in SIZE_TIERS:
        expr = expr.when(x < bound, F.lit(label))
    return expr.otherwise(F.lit(TOP_TIER))


def pct_vs_benchmark(value, benchmark) -> Column:
    v, m = _col(value), _col(benchmark)
    ok = m.isNotNull() & (F.abs(m) > BENCHMARK_EPSILON) & v.isNotNull()
    return F.when(ok, (v - m) / m * F.lit(100.0))
