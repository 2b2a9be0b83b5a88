"""Data-quality checks as Spark aggregates.

Every check yields one verdict row ``(check_name, table_name, severity,
violations, passed)``. ``run_checks`` reads each table once and needs one keyed
exchange, however many checks there are: a row becomes a few tallies
``(check, key, own, ref)``, one per row rule that it breaks, per uniqueness rule,
per key it refers to and per key it offers as a reference. Tallies of all tables
are added up by (check, key); a group then says by itself whether its key repeats,
is an orphan or has a partner. A second aggregate, by check, sees a row per check
and task.

Skew: tallies are combined before the shuffle, so a key holding a third of all
rows is one row a task when it travels. NULL keys form one group for uniqueness
and count as orphans for foreign keys (NOT EXISTS semantics).

Keys are compared by their text forms, a reference key cast to the type of the key
that refers to it.
"""
from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR, WARN = "ERROR", "WARN"
RESULT_COLUMNS = ["check_name", "table_name", "severity", "violations", "passed"]

Violation = Callable[[], Column]


@dataclass(frozen=True)
class RuleCheck:
    """Counts rows where ``violation()`` is TRUE (NULL counts as no violation)."""
    name: str
    table: str
    violation: Violation
    severity: str = ERROR


@dataclass(frozen=True)
class UniqueCheck:
    """Counts key groups holding more than one row."""
    name: str
    table: str
    keys: tuple[str, ...]
    severity: str = ERROR


@dataclass(frozen=True)
class ForeignKeyCheck:
    """Counts rows (optionally filtered) whose key has no partner in ``ref_table`` (optionally filtered)."""
    name: str
    table: str
    key: tuple[str, ...]
    ref_table: str
    ref_key: tuple[str, ...]
    severity: str = ERROR
    ref_filter: Violation | None = None
    row_filter: Violation | None = None


@dataclass(frozen=True)
class MatchCheck:
    """Counts rows of ``table`` (filtered) that DO have a partner in ``ref_table``
    (filtered): a semi join, for "should not appear together" rules."""
    name: str
    table: str
    key: tuple[str, ...]
    ref_table: str
    ref_key: tuple[str, ...]
    row_filter: Violation | None = None
    ref_filter: Violation | None = None
    severity: str = ERROR


@dataclass(frozen=True)
class IntervalCheck:
    """Counts rows whose ``value`` lies in none of the intervals that ``ref_table`` lists for the row's ``key``.

    An interval is ``(ref_key, lo, hi)``, ends included, a NULL end open. Keys without an interval, NULL keys and
    NULL values break nothing."""
    name: str
    table: str
    key: str
    value: str
    ref_table: str
    ref_key: str
    lo: str = "lo"
    hi: str = "hi"
    severity: str = ERROR


Check = RuleCheck | UniqueCheck | ForeignKeyCheck | MatchCheck | IntervalCheck


RULE, UNIQUE, ORPHAN, PARTNER = range(4)
KINDS = {RuleCheck: RULE, UniqueCheck: UNIQUE, ForeignKeyCheck: ORPHAN, MatchCheck: PARTNER, IntervalCheck: RULE}


def _key(values: Sequence[Column]) -> Column:
    """Text that tells keys apart, NULL parts included: every part with its length before it."""
    text = [v.cast("string") for v in values]
    return F.concat(*[F.coalesce(F.concat(F.length(t), F.lit(":"), t), F.lit("-")) for t in text])


def _tally(check: int, key: Column, own: int, ref: int, when: Column | None = None) -> Column:
    tally = F.struct(F.lit(check).alias("check"), key.alias("key"), F.lit(own).cast("bigint").alias("own"),
                     F.lit(ref).cast("bigint").alias("ref"))
    return tally if when is None else F.when(when, tally)


def _tallies(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> dict[str, list[Column]]:
    """What a row of each table adds to which check; a NULL entry adds nothing."""
    out: dict[str, list[Column]] = {}
    for i, c in enumerate(checks):
        mine = out.setdefault(c.table, [])
        if isinstance(c, RuleCheck):
            mine.append(_tally(i, F.lit(""), 1, 0, c.violation()))
        elif isinstance(c, IntervalCheck):
            value, met = F.col(c.value), F.col(_bounds(i))
            inside = F.exists(met, lambda b: F.coalesce(value >= b["lo"], F.lit(True)) & F.coalesce(value <= b["hi"], F.lit(True)))  # noqa: B023
            mine.append(_tally(i, F.lit(""), 1, 0, value.isNotNull() & met.isNotNull() & ~inside))
        elif isinstance(c, UniqueCheck):
            mine.append(_tally(i, _key([F.col(k) for k in c.keys]), 1, 0))
        else:
            mine.append(_tally(i, _key([F.col(k) for k in c.key]), 1, 0, c.row_filter and c.row_filter()))
            types = [tables[c.table].schema[k].dataType for k in c.key]
            parts = [F.col(r).cast(t) for r, t in zip(c.ref_key, types, strict=True)]
            offered = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
            if c.ref_filter is not None:
                offered = offered & c.ref_filter()
            out.setdefault(c.ref_table, []).append(_tally(i, _key(parts), 0, 1, offered))
    return out


def _bounds(check: int) -> str:
    return f"_bounds_of_check_{check}"


def _with_bounds(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> dict[str, DataFrame]:
    """Tables whose rows hold the intervals of their key, for each interval check.

    The rules are one row a key, so the join adds no rows; it is a broadcast where their measured size allows, else
    a sort-merge join that splits hot keys."""
    out = dict(tables)
    for i, c in enumerate(checks):
        if isinstance(c, IntervalCheck):
            types = tables[c.table].schema
            lo, hi = (F.col(b).cast(types[c.value].dataType).alias(n) for b, n in ((c.lo, "lo"), (c.hi, "hi")))
            key = f"_key_of_check_{i}"
            rules = (tables[c.ref_table].select(F.col(c.ref_key).cast(types[c.key].dataType).alias(key), F.struct(lo, hi).alias("bound"))
                     .groupBy(key).agg(F.collect_set("bound").alias(_bounds(i))))
            out[c.table] = out[c.table].join(rules, F.col(c.key) == F.col(key), "left").drop(key)
    return out


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """A verdict per check, in no order. Checks without rows to look at pass with 0 violations."""
    tables = _with_bounds(tables, checks)
    parts = [tables[name].select(F.inline(F.array_compact(F.array(*tallies))))
             for name, tallies in _tallies(tables, checks).items()]
    groups = reduce(DataFrame.unionAll, parts).groupBy("check", "key").agg(
        F.sum("own").alias("own"), F.sum("ref").alias("ref"))
    found = groups.groupBy("check").agg(
        F.sum("own").alias(f"_v{RULE}"),
        F.count_if(F.col("own") > 1).alias(f"_v{UNIQUE}"),
        F.sum(F.when(F.col("ref") == 0, F.col("own"))).alias(f"_v{ORPHAN}"),
        F.sum(F.when(F.col("ref") > 0, F.col("own"))).alias(f"_v{PARTNER}"))
    listed = F.array(*[
        F.struct(F.lit(i).alias("number"), F.lit(KINDS[type(c)]).alias("kind"), F.lit(c.name).alias("check_name"),
                 F.lit(c.table).alias("table_name"), F.lit(c.severity).alias("severity"))
        for i, c in enumerate(checks)])
    spark = parts[0].sparkSession
    verdicts = spark.range(1).select(F.inline(listed)).join(found, F.col("number") == F.col("check"), "left")
    counted = F.coalesce(*[F.when(F.col("kind") == k, F.col(f"_v{k}")) for k in KINDS.values()], F.lit(0))
    return verdicts.withColumn("violations", counted.cast("bigint")).withColumn(
        "passed", F.col("violations") == 0).select(*RESULT_COLUMNS)


def run_check(tables: Mapping[str, DataFrame], check: Check) -> DataFrame:
    return run_checks(tables, [check])


# --- generic builders -------------------------------------------------------

def non_negative(columns: Sequence[str]) -> Violation:
    """Violation: any listed column set and below zero (NULL is allowed)."""
    return lambda: reduce(lambda a, b: a | b,
                          [F.col(c).isNotNull() & (F.col(c) < 0) for c in columns])


def outside(column: str, lo: float, hi: float) -> Violation:
    return lambda: F.col(column).isNotNull() & ~F.col(column).between(lo, hi)


@dataclass(frozen=True)
class CheckSuite:
    checks: list[Check] = field(default_factory=list)

    def names(self) -> list[str]:
        return [c.name for c in self.checks]

    def get(self, name: str) -> Check:
        return next(c for c in self.checks if c.name == name)
