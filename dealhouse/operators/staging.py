"""Raw (all-string) -> typed staging, with quarantine and content hashes.

Every function is a pure ``DataFrame -> DataFrame`` projection/filter; Catalyst
fuses each into one whole-stage-codegen span on top of the scan.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealhouse.functions import (
    clean_str,
    content_hash,
    date_or_null,
    double_or_null,
    int_or_null,
    is_blank,
    norm_id,
)

# Staged column sets (the warehouse data model), in table order.
ACQUIRER_COLUMNS = [
    "acquirer_id", "acquirer_name", "acquirer_type", "primary_sector_focus", "headquarters",
    "ticker_or_status", "employee_count", "annual_revenue_mm", "founded_date", "geographic_reach",
]
TARGET_COLUMNS = [
    "target_id", "target_name", "sector", "sub_sector", "geography", "ownership_type",
    "founded_date", "employee_count", "ltm_revenue_mm", "ebitda_margin_pct", "revenue_growth_pct",
]
TRANSACTION_COLUMNS = [
    "transaction_id", "target_id", "acquirer_id", "announce_date", "close_date", "deal_year",
    "deal_quarter", "deal_type", "financing_type", "deal_size_mm", "ev_ebitda_multiple",
    "ev_revenue_multiple", "synergy_pct_of_deal", "outcome", "strategic_rationale_tags",
    "num_bidders", "days_to_close",
]
FINANCIAL_COLUMNS = [
    "acquirer_id", "fiscal_year", "revenue_mm", "ebitda_mm", "ebitda_margin_pct", "net_debt_mm",
    "cash_on_hand_mm", "total_assets_mm", "market_cap_mm", "employee_count",
]
MULTIPLE_COLUMNS = [
    "sector", "fiscal_year", "fiscal_quarter", "median_ev_ebitda", "p25_ev_ebitda",
    "p75_ev_ebitda", "median_ev_revenue", "p25_ev_revenue", "p75_ev_revenue", "deal_count",
]
# Canonical acquirer type labels (matched case-insensitively).
ACQUIRER_TYPE_LABELS = {"strategic": "Strategic", "financial sponsor": "Financial Sponsor"}

QUARANTINE_MISSING_ID = "missing_transaction_id"
QUARANTINE_NEGATIVE_SIZE = "negative_deal_size"


def with_hash(df: DataFrame, key: list[str]) -> DataFrame:
    attrs = [c for c in df.columns if c not in key]
    return df.withColumn("row_content_hash", content_hash(df, attrs))


def stg_acquirers(raw: DataFrame) -> DataFrame:
    kind = F.lower(clean_str(F.coalesce(F.col("acquirer_type"), F.lit(""))))
    label = clean_str("acquirer_type")
    for lower_form, canonical in ACQUIRER_TYPE_LABELS.items():
        label = F.when(kind == lower_form, F.lit(canonical)).otherwise(label)
    b = raw.filter(~is_blank("acquirer_id")).select(
        norm_id("acquirer_id").alias("acquirer_id"),
        clean_str("acquirer_name").alias("acquirer_name"),
        label.alias("acquirer_type"),
        clean_str("primary_sector_focus").alias("primary_sector_focus"),
        clean_str("headquarters").alias("headquarters"),
        clean_str("ticker_or_status").alias("ticker_or_status"),
        int_or_null("employee_count").alias("employee_count"),
        double_or_null("annual_revenue_mm").alias("annual_revenue_mm"),
        date_or_null("founded_date").alias("founded_date"),
        clean_str("geographic_reach").alias("geographic_reach"),
    )
    return with_hash(b, ["acquirer_id"])


def stg_targets(raw: DataFrame) -> DataFrame:
    b = raw.filter(~is_blank("target_id")).select(
        norm_id("target_id").alias("target_id"),
        *[clean_str(c).alias(c) for c in ("target_name", "sector", "sub_sector", "geography", "ownership_type")],
        date_or_null("founded_date").alias("founded_date"),
        int_or_null("employee_count").alias("employee_count"),
        *[double_or_null(c).alias(c) for c in ("ltm_revenue_mm", "ebitda_margin_pct", "revenue_growth_pct")],
    )
    return with_hash(b, ["target_id"])


def flag_transactions(raw: DataFrame) -> DataFrame:
    """Raw rows plus ``quarantine_reason`` (NULL for clean rows).

    The reason is computed once; clean and quarantine outputs are exact
    complements by construction (no NULL can fall between them)."""
    size = double_or_null("deal_size_mm")
    reason = (
        F.when(is_blank("transaction_id"), F.lit(QUARANTINE_MISSING_ID))
        .when(size.isNotNull() & (size < 0), F.lit(QUARANTINE_NEGATIVE_SIZE))
    )
    return raw.withColumn("quarantine_reason", reason)


def transactions_quarantine(raw: DataFrame) -> DataFrame:
    return flag_transactions(raw).filter(F.col("quarantine_reason").isNotNull())


def _typed_transactions(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(
        *[norm_id(c).alias(c) for c in ("transaction_id", "target_id", "acquirer_id")],
        date_or_null("announce_date").alias("announce_date"),
        F.when(is_blank("close_date"), F.lit(None).cast("date"))
        .otherwise(date_or_null("close_date"))
        .alias("close_date"),
        int_or_null("deal_year").alias("deal_year"),
        *[clean_str(c).alias(c) for c in ("deal_quarter", "deal_type", "financing_type")],
        *[double_or_null(c).alias(c) for c in
          ("deal_size_mm", "ev_ebitda_multiple", "ev_revenue_multiple", "synergy_pct_of_deal")],
        clean_str("outcome").alias("outcome"),
        clean_str("strategic_rationale_tags").alias("strategic_rationale_tags"),
        int_or_null("num_bidders").alias("num_bidders"),
        int_or_null("days_to_close").alias("days_to_close"),
        *keep,
    )


def stg_transactions(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Clean, typed deals; the columns ``keep`` pass through."""
    return _typed_transactions(flag_transactions(raw).filter(F.col("quarantine_reason").isNull()), keep)


def stg_acquirer_financials(raw: DataFrame) -> DataFrame:
    doubles = ["revenue_mm", "ebitda_mm", "ebitda_margin_pct", "net_debt_mm",
               "cash_on_hand_mm", "total_assets_mm", "market_cap_mm"]
    return raw.filter(~is_blank("acquirer_id")).select(
        norm_id("acquirer_id").alias("acquirer_id"),
        int_or_null("fiscal_year").alias("fiscal_year"),
        *[double_or_null(c).alias(c) for c in doubles],
        int_or_null("employee_count").alias("employee_count"),
    )


def stg_sector_multiples(raw: DataFrame) -> DataFrame:
    doubles = MULTIPLE_COLUMNS[3:9]
    return raw.select(
        clean_str("sector").alias("sector"),
        int_or_null("fiscal_year").alias("fiscal_year"),
        clean_str("fiscal_quarter").alias("fiscal_quarter"),
        *[double_or_null(c).alias(c) for c in doubles],
        int_or_null("deal_count").alias("deal_count"),
    )


STAGERS = {
    "acquirers": stg_acquirers,
    "targets": stg_targets,
    "transactions": stg_transactions,
    "acquirer_financials": stg_acquirer_financials,
    "sector_multiples": stg_sector_multiples,
}
