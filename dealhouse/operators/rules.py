"""The warehouse's check catalogue over the staging tables.

Table names are the staged entity names: acquirers, targets, transactions,
acquirer_financials, sector_multiples; ``raw_*`` for landed strings and
``nation`` for the geography reference; ``ref_*`` for rule tables (``ref_deal_financing``:
financing that a deal type may have; ``ref_multiple_bounds``: intervals of the multiple by deal type).
"""
from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from dealhouse.functions.text import clean_str
from dealhouse.operators.quality import (
    WARN,
    CheckSuite,
    ForeignKeyCheck,
    IntervalCheck,
    MatchCheck,
    RuleCheck,
    UniqueCheck,
    non_negative,
    outside,
)

# Documented plausibility bounds and patterns.
FISCAL_YEAR_RANGE = (1990, 2035)
SYNERGY_CAP_PCT = 100.0
EV_EBITDA_RANGE = (0.0, 100.0)
BUSINESS_DAY_TOLERANCE = 1
REVENUE_PER_HEAD_BAND_MM = (0.001, 5.0)
ID_PATTERNS = {"transaction_id": r"^TXN-[0-9]+$", "target_id": r"^TGT-[0-9]+$",
               "acquirer_id": r"^ACQ-[0-9]+$"}
NULL_SENTINELS = ("NULL", "NAN", "NONE", "N/A")
SPONSOR_LABEL = "Financial Sponsor"
PRIVATE_LABEL = "Private"


def _both(a: str, b: str) -> Column:
    return F.col(a).isNotNull() & F.col(b).isNotNull()


def _overlap(lo: Column, hi: Column, a: int, b: int) -> Column:
    return F.greatest(F.lit(0), F.least(hi, F.lit(b)) - F.greatest(lo, F.lit(a)))


def business_days_between(start: str, end: str) -> Column:
    """Weekdays d with start < d <= end (closed form, no per-day expansion)."""
    n = F.datediff(F.col(end), F.col(start))
    weeks = F.floor(n / 7).cast("int")
    rest = n - weeks * 7
    first = (F.dayofweek(F.date_add(F.col(start), 1)) + 5) % 7  # Monday = 0
    extra = _overlap(first, first + rest, 0, 5) + _overlap(first, first + rest, 7, 12)
    return F.when(n >= 0, weeks * 5 + extra)


def _business_days_violation() -> Column:
    bd = business_days_between("announce_date", "close_date")
    return (_both("announce_date", "close_date") & F.col("days_to_close").isNotNull() & bd.isNotNull()
            & (F.abs(F.col("days_to_close") - bd) > BUSINESS_DAY_TOLERANCE))


def _id_format(*columns: str) -> Callable[[], Column]:
    return lambda: reduce(or_, [F.col(c).isNotNull() & ~F.col(c).rlike(ID_PATTERNS[c]) for c in columns])


def _percentile_order_violation() -> Column:
    def disorder(kind: str) -> Column:
        p25, med, p75 = (F.col(f"{q}_ev_{kind}") for q in ("p25", "median", "p75"))
        return (p25 > med) | (med > p75)
    return F.coalesce(disorder("ebitda"), F.lit(False)) | F.coalesce(disorder("revenue"), F.lit(False))


def _revenue_per_head_violation() -> Column:
    lo, hi = REVENUE_PER_HEAD_BAND_MM
    per_head = F.col("ltm_revenue_mm") / F.col("employee_count")
    return (F.col("employee_count") > 0) & F.col("ltm_revenue_mm").isNotNull() & ~per_head.between(lo, hi)


def null_sentinel_violation(columns: list[str]) -> Column:
    hits = [F.upper(clean_str(F.col(c))).isin(list(NULL_SENTINELS)) for c in columns]
    out = hits[0]
    for h in hits[1:]:
        out = out | h
    return out


CODED = CheckSuite([
    UniqueCheck("chk_transactions_unique", "transactions", ("transaction_id",)),
    ForeignKeyCheck("chk_transactions_fk_acquirer", "transactions", ("acquirer_id",),
                    "acquirers", ("acquirer_id",)),
    ForeignKeyCheck("chk_transactions_fk_target", "transactions", ("target_id",), "targets", ("target_id",)),
    RuleCheck("chk_date_order", "transactions",
              lambda: _both("announce_date", "close_date") & (F.col("close_date") < F.col("announce_date"))),
    RuleCheck("chk_closed_requires_close_date", "transactions",
              lambda: (F.lower(clean_str(F.coalesce(F.col("outcome"), F.lit("")))) == "closed")
              & F.col("close_date").isNull()),
    RuleCheck("chk_dates_require_days_to_close", "transactions",
              lambda: _both("announce_date", "close_date") & F.col("days_to_close").isNull()),
    UniqueCheck("chk_targets_unique", "targets", ("target_id",)),
    UniqueCheck("chk_acquirers_unique", "acquirers", ("acquirer_id",)),
    RuleCheck("chk_nonneg_acquirers", "acquirers", non_negative(["employee_count", "annual_revenue_mm"])),
    RuleCheck("chk_nonneg_targets", "targets", non_negative(["employee_count", "ltm_revenue_mm"])),
    RuleCheck("chk_nonneg_transactions", "transactions", non_negative(
        ["deal_size_mm", "ev_ebitda_multiple", "ev_revenue_multiple", "synergy_pct_of_deal",
         "num_bidders", "days_to_close"])),
    RuleCheck("chk_nonneg_financials", "acquirer_financials", non_negative(
        ["employee_count", "revenue_mm", "ebitda_mm", "cash_on_hand_mm", "total_assets_mm", "market_cap_mm"])),
    RuleCheck("chk_nonneg_sector_multiples", "sector_multiples", non_negative(
        ["median_ev_ebitda", "p25_ev_ebitda", "p75_ev_ebitda", "median_ev_revenue", "p25_ev_revenue",
         "p75_ev_revenue", "deal_count"])),
])

DOCUMENTED = CheckSuite([
    RuleCheck("chk_year_matches_announce", "transactions",
              lambda: _both("deal_year", "announce_date") & (F.col("deal_year") != F.year("announce_date"))),
    RuleCheck("chk_quarter_matches_announce", "transactions",
              lambda: _both("deal_quarter", "announce_date")
              & (F.col("deal_quarter") != F.concat(F.lit("Q"), F.quarter("announce_date").cast("string")))),
    RuleCheck("chk_percentile_order", "sector_multiples", _percentile_order_violation),
    UniqueCheck("chk_unique_fiscal_grain", "acquirer_financials", ("acquirer_id", "fiscal_year")),
    UniqueCheck("chk_unique_benchmark_grain", "sector_multiples", ("sector", "fiscal_year", "fiscal_quarter")),
    RuleCheck("chk_id_format", "transactions", _id_format("transaction_id", "target_id", "acquirer_id")),
    RuleCheck("chk_id_format_acquirers", "acquirers", _id_format("acquirer_id")),
    RuleCheck("chk_id_format_targets", "targets", _id_format("target_id")),
    MatchCheck("chk_sponsor_in_financials", "acquirers", ("acquirer_id",), "acquirer_financials",
               ("acquirer_id",), row_filter=lambda: F.col("acquirer_type") == SPONSOR_LABEL),
    RuleCheck("chk_business_days", "transactions", _business_days_violation, WARN),
    RuleCheck("chk_fiscal_year_range", "acquirer_financials", outside("fiscal_year", *FISCAL_YEAR_RANGE)),
    RuleCheck("chk_synergy_cap", "transactions",
              lambda: F.col("synergy_pct_of_deal").isNotNull() & (F.col("synergy_pct_of_deal") > SYNERGY_CAP_PCT)),
    RuleCheck("chk_value_range", "transactions", outside("ev_ebitda_multiple", *EV_EBITDA_RANGE), WARN),
    ForeignKeyCheck("chk_allowed_matrix", "acquirers", ("headquarters",), "nation", ("n_name",),
                    severity=WARN),
    ForeignKeyCheck("chk_financing_by_deal_type", "transactions", ("deal_type", "financing_type"),
                    "ref_deal_financing", ("deal_type", "financing_type"), severity=WARN,
                    row_filter=lambda: _both("deal_type", "financing_type")),
    ForeignKeyCheck("chk_sub_sector_of_sector", "targets", ("sector", "sub_sector"), "ref_sector_tree",
                    ("sector", "sub_sector"), severity=WARN, row_filter=lambda: _both("sector", "sub_sector")),
    IntervalCheck("chk_multiple_by_deal_type", "transactions", "deal_type", "ev_ebitda_multiple",
                  "ref_multiple_bounds", "deal_type", severity=WARN),
    MatchCheck("chk_private_has_no_market_cap", "acquirer_financials", ("acquirer_id",), "acquirers",
               ("acquirer_id",), row_filter=lambda: F.col("market_cap_mm").isNotNull(),
               ref_filter=lambda: F.col("ticker_or_status") == PRIVATE_LABEL),
    RuleCheck("chk_size_vs_headcount", "targets", _revenue_per_head_violation, WARN),
])

ALL_CHECKS = CheckSuite(CODED.checks + DOCUMENTED.checks)
