"""Analytics models as DataFrame plans.

Scale notes (each plan was checked with ``explain('formatted')``):

* ``fct_transactions``: four left joins from the deal grain. Sides are broadcast only
  where AQE measures them under the session's bound; otherwise sort-merge, and the skew
  rule may split a hot target or acquirer even where that costs another shuffle
  (``forceOptimizeSkewedJoin``).
* ``rpt_sector_trend_summary``: deals are pre-aggregated to
  (target_id, deal_year) *before* the join to ``dim_target``, so the join and
  its shuffle see one row per pair instead of one per deal, and a hot target
  collapses to a handful of rows. Sums are exact decimals, so re-aggregating
  partials is exact.
* ``dim_acquirer_activity``: deals are aggregated by (acquirer, announce date) first,
  measures and ordered lists alike, then those partials by acquirer: one scan, and no task
  sorts more than one day of an acquirer's deals. Names are joined after aggregation.
* ``fct_target_deal_sequence``: numbered by ``sequence_with_prior`` before the join to
  ``dim_target``, so the join adds columns to finished rows.
* With ``small``, over written deals, the last two take groups of at most so many deals in one
  step; only larger groups are cut into days or slices.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealhouse.operators.sequence import by_size, sequence_parts, sequence_with_prior
from dealhouse.functions.measures import (
    avg_from_parts,
    deal_size_tier,
    fixed_sum_exact,
    pct_vs_benchmark,
)

# Years that the partitioned fact may hold; others, and deals without a year, stay in staging.
YEAR_DOMAIN = range(1990, 2036)
STRING_AGG_SEPARATOR = " | "
UNKNOWN_SECTOR = "Unknown"

# Published column orders of the analytics tables.
DIM_ACQUIRER_COLUMNS = [
    "acquirer_id", "acquirer_name", "acquirer_type", "primary_sector_focus", "headquarters",
    "ticker_or_status", "employee_count", "annual_revenue_mm", "founded_date", "geographic_reach",
    "row_content_hash", "dw_updated_at", "data_date",
]
DIM_TARGET_COLUMNS = [
    "target_id", "target_name", "sector", "sub_sector", "geography", "ownership_type", "founded_date",
    "employee_count", "ltm_revenue_mm", "ebitda_margin_pct", "revenue_growth_pct",
    "row_content_hash", "dw_updated_at", "data_date",
]
FACT_COLUMNS = [
    "transaction_id", "target_id", "acquirer_id", "announce_date", "close_date", "deal_year",
    "deal_quarter", "deal_type", "financing_type", "deal_size_mm", "ev_ebitda_multiple",
    "ev_revenue_multiple", "synergy_pct_of_deal", "outcome", "strategic_rationale_tags",
    "num_bidders", "days_to_close", "target_name", "target_sector", "target_sub_sector",
    "target_geography", "target_ownership_type", "target_ltm_revenue_mm", "target_ebitda_margin_pct",
    "acquirer_name", "acquirer_type", "acquirer_sector_focus", "acquirer_geographic_reach",
    "sector_median_ev_ebitda", "sector_median_ev_revenue", "ev_ebitda_pct_vs_sector_median",
    "ev_revenue_pct_vs_sector_median", "acquirer_fiscal_revenue_mm", "acquirer_fiscal_ebitda_mm",
    "acquirer_net_debt_mm", "acquirer_cash_mm", "acquirer_total_assets_mm", "deal_size_tier", "data_date",
]
ACTIVITY_COLUMNS = [
    "acquirer_id", "acquirer_name", "acquirer_type", "deal_count", "total_deal_volume_mm",
    "avg_ev_ebitda_multiple", "avg_ev_revenue_multiple", "distinct_target_sectors",
    "deal_types_observed", "sectors_touched", "first_transaction_date", "most_recent_transaction_date",
    "avg_deals_per_active_year", "row_content_hash", "dw_updated_at", "data_date",
]
REPORT_COLUMNS = [
    "sector", "deal_year", "transaction_count", "total_deal_size_mm", "avg_ev_ebitda_multiple",
    "avg_ev_revenue_multiple", "closed_deal_count", "pending_deal_count", "data_date",
]
SEQUENCE_COLUMNS = [
    "target_id", "deal_sequence_number", "transaction_id", "acquirer_id", "announce_date", "close_date",
    "deal_year", "deal_quarter", "deal_type", "financing_type", "outcome", "deal_size_mm",
    "ev_ebitda_multiple", "ev_revenue_multiple", "num_bidders", "days_to_close", "target_name",
    "target_sector", "prior_transaction_id", "prior_announce_date", "prior_close_date", "prior_outcome",
    "prior_deal_size_mm", "prior_ev_ebitda_multiple", "prior_acquirer_id", "days_since_prior_announce",
    "deal_size_mm_delta_vs_prior", "ev_ebitda_multiple_delta_vs_prior", "same_acquirer_as_prior", "data_date",
]
LAGGED_COLUMNS = ["transaction_id", "announce_date", "close_date", "outcome", "deal_size_mm",
                  "ev_ebitda_multiple", "acquirer_id"]


def _stamp(d: dt.date) -> F.Column:
    return F.lit(d).cast("date")


def dimension_rows(staged: DataFrame, columns: list[str], run_ts: dt.datetime) -> DataFrame:
    """Staging rows plus load stamps, in dimension column order."""
    return staged.select(
        *[c for c in columns if c not in ("dw_updated_at", "data_date")],
        F.lit(run_ts).cast("timestamp").alias("dw_updated_at"),
        _stamp(run_ts.date()).alias("data_date"),
    )


def fct_transactions(tx: DataFrame, dim_target: DataFrame, dim_acquirer: DataFrame,
                     multiples: DataFrame, financials: DataFrame, data_date: dt.date,
                     years: list[int] | None = None, domain: range | None = YEAR_DOMAIN) -> DataFrame:
    """One row per deal, with its target, benchmark and buyer; of a year in ``domain`` (none: of any year,
    or without one), and with ``years`` only of those."""
    t = tx if domain is None else tx.filter(F.col("deal_year").between(domain.start, domain.stop - 1))
    if years is not None:
        t = t.filter(F.col("deal_year").isin(list(years)))
    tg = dim_target.select(
        F.col("target_id").alias("_tg_id"), "target_name",
        F.col("sector").alias("target_sector"), F.col("sub_sector").alias("target_sub_sector"),
        F.col("geography").alias("target_geography"), F.col("ownership_type").alias("target_ownership_type"),
        F.col("ltm_revenue_mm").alias("target_ltm_revenue_mm"),
        F.col("ebitda_margin_pct").alias("target_ebitda_margin_pct"),
    )
    aq = dim_acquirer.select(
        F.col("acquirer_id").alias("_aq_id"), "acquirer_name", "acquirer_type",
        F.col("primary_sector_focus").alias("acquirer_sector_focus"),
        F.col("geographic_reach").alias("acquirer_geographic_reach"),
    )
    sm = multiples.select(
        F.col("sector").alias("_sm_sector"), F.col("fiscal_year").alias("_sm_year"),
        F.col("fiscal_quarter").alias("_sm_quarter"),
        F.col("median_ev_ebitda").alias("sector_median_ev_ebitda"),
        F.col("median_ev_revenue").alias("sector_median_ev_revenue"),
    )
    af = financials.select(
        F.col("acquirer_id").alias("_af_id"), F.col("fiscal_year").alias("_af_year"),
        F.col("revenue_mm").alias("acquirer_fiscal_revenue_mm"),
        F.col("ebitda_mm").alias("acquirer_fiscal_ebitda_mm"),
        F.col("net_debt_mm").alias("acquirer_net_debt_mm"),
        F.col("cash_on_hand_mm").alias("acquirer_cash_mm"),
        F.col("total_assets_mm").alias("acquirer_total_assets_mm"),
    )
    j = (
        t.join(tg, F.col("_tg_id") == F.col("target_id"), "left")
        .join(sm, (F.col("_sm_sector") == F.col("target_sector"))
              & (F.col("_sm_year") == F.col("deal_year"))
              & (F.col("_sm_quarter") == F.col("deal_quarter")), "left")
        .join(aq, F.col("_aq_id") == F.col("acquirer_id"), "left")
        .join(af, (F.col("_af_id") == F.col("acquirer_id"))
              & (F.col("_af_year") == F.year("announce_date")), "left")
    )
    out = j.withColumns({
        "ev_ebitda_pct_vs_sector_median": pct_vs_benchmark("ev_ebitda_multiple", "sector_median_ev_ebitda"),
        "ev_revenue_pct_vs_sector_median": pct_vs_benchmark("ev_revenue_multiple", "sector_median_ev_revenue"),
        "deal_size_tier": deal_size_tier("deal_size_mm"),
        "data_date": _stamp(data_date),
    })
    return out.select(*FACT_COLUMNS)


def _joined(value: str, order: list[str]) -> F.Column:
    by = ", ".join(f"{c} ASC NULLS LAST" for c in order)
    return F.expr(f"listagg({value}, '{STRING_AGG_SEPARATOR}') WITHIN GROUP (ORDER BY {by})")


def activity_measures(tx: DataFrame, dim_target: DataFrame, small: int | None = None) -> DataFrame:
    """Per-acquirer measures (no names, no stamps) of deals, with the sectors of their targets.

    With ``small``, acquirers of at most so many deals are aggregated in one step: ``tx`` is then read
    more than once, hand in a written table."""
    deals = tx.select(
        "acquirer_id", "transaction_id", "deal_year", "deal_type", "deal_size_mm",
        "ev_ebitda_multiple", "ev_revenue_multiple", "announce_date", "target_id",
    )

    def with_sector(part: DataFrame) -> DataFrame:
        return part.join(
            dim_target.select(F.col("target_id").alias("_tg_id"), F.col("sector").alias("target_sector")),
            F.col("_tg_id") == F.col("target_id"), "left",
        )

    if small is None:
        return activity_of(with_sector(deals))
    few, many = by_size(deals, "acquirer_id", small)
    return _activity_of_parts(with_sector(few), with_sector(many))


def activity_by_size(deals: DataFrame, small: int) -> DataFrame:
    """``activity_of``, acquirers of at most ``small`` deals in one step: ``deals`` are read more than once."""
    return _activity_of_parts(*by_size(deals, "acquirer_id", small))


def _activity_of_parts(few: DataFrame, many: DataFrame) -> DataFrame:
    return _activity_shown(_activity_at_once(few)).unionByName(activity_of(many))


def _activity_at_once(deals: DataFrame) -> DataFrame:
    """Parts of the measures from all deals of an acquirer together, in the order of ``activity_of``."""
    label = F.coalesce(F.col("target_sector"), F.lit(UNKNOWN_SECTOR))
    # A flag before each value puts NULLs last.
    keys = [("announce_date", F.col("announce_date")), ("transaction_id", F.col("transaction_id")),
            ("deal_type", F.col("deal_type")), ("label", label)]
    entry = F.struct(*[x for n, c in keys for x in (c.isNull().alias(f"no_{n}"), c.alias(n))], "target_sector")

    def listed(field: str) -> F.Column:
        held = F.filter(F.transform("_deals", lambda d: d[field]), lambda x: x.isNotNull())
        return F.when(F.size(held) > 0, F.array_join(held, STRING_AGG_SEPARATOR))

    g = deals.repartition("acquirer_id").groupBy("acquirer_id").agg(
        F.count(F.lit(1)).alias("deal_count"),
        fixed_sum_exact("deal_size_mm").alias("_vol"),
        fixed_sum_exact("ev_ebitda_multiple").alias("_e_sum"), F.count("ev_ebitda_multiple").alias("_e_n"),
        fixed_sum_exact("ev_revenue_multiple").alias("_r_sum"), F.count("ev_revenue_multiple").alias("_r_n"),
        F.sort_array(F.collect_list(entry)).alias("_deals"),
        F.min("announce_date").alias("first_transaction_date"),
        F.max("announce_date").alias("most_recent_transaction_date"),
        (F.max("deal_year") - F.min("deal_year") + 1).alias("_span"),
    )
    return g.select(
        *[c for c in g.columns if c != "_deals"],
        F.size(F.array_distinct(F.filter(F.transform("_deals", lambda d: d["target_sector"]), lambda x: x.isNotNull())))
        .cast("bigint").alias("distinct_target_sectors"),
        listed("deal_type").alias("deal_types_observed"), listed("label").alias("sectors_touched"))


def activity_of(deals: DataFrame) -> DataFrame:
    """Measures of deals that carry ``target_sector``: by day first, then the days of an acquirer.

    Lists are in the order of date, id, and the two listed values."""
    enriched = deals.withColumn("sector_label", F.coalesce(F.col("target_sector"), F.lit(UNKNOWN_SECTOR)))
    in_day = ["transaction_id", "deal_type", "sector_label"]
    days = enriched.groupBy("acquirer_id", "announce_date").agg(
        F.count(F.lit(1)).alias("n"),
        fixed_sum_exact("deal_size_mm").alias("vol"),
        fixed_sum_exact("ev_ebitda_multiple").alias("e_sum"), F.count("ev_ebitda_multiple").alias("e_n"),
        fixed_sum_exact("ev_revenue_multiple").alias("r_sum"), F.count("ev_revenue_multiple").alias("r_n"),
        F.sort_array(F.collect_set("target_sector")).alias("sectors"),
        _joined("deal_type", in_day).alias("types"), _joined("sector_label", in_day).alias("labels"),
        F.min("deal_year").alias("from_year"), F.max("deal_year").alias("to_year"),
    )
    g = days.groupBy("acquirer_id").agg(
        F.sum("n").alias("deal_count"),
        F.sum("vol").cast("decimal(38,6)").alias("_vol"),
        F.sum("e_sum").cast("decimal(38,6)").alias("_e_sum"), F.sum("e_n").alias("_e_n"),
        F.sum("r_sum").cast("decimal(38,6)").alias("_r_sum"), F.sum("r_n").alias("_r_n"),
        # sets of sector names, a short list whatever the number of deals
        F.size(F.array_distinct(F.flatten(F.collect_set("sectors")))).cast("bigint").alias("distinct_target_sectors"),
        _joined("types", ["announce_date"]).alias("deal_types_observed"),
        _joined("labels", ["announce_date"]).alias("sectors_touched"),
        F.min("announce_date").alias("first_transaction_date"),
        F.max("announce_date").alias("most_recent_transaction_date"),
        (F.max("to_year") - F.min("from_year") + 1).alias("_span"),
    )
    return _activity_shown(g)


def _activity_shown(g: DataFrame) -> DataFrame:
    # A NULL acquirer never matches its own span row in the SQL this mirrors.
    span = F.when(F.col("acquirer_id").isNotNull(), F.col("_span"))
    return g.select(
        "acquirer_id", "deal_count",
        F.col("_vol").cast("double").alias("total_deal_volume_mm"),
        avg_from_parts(F.col("_e_sum"), F.col("_e_n")).alias("avg_ev_ebitda_multiple"),
        avg_from_parts(F.col("_r_sum"), F.col("_r_n")).alias("avg_ev_revenue_multiple"),
        "distinct_target_sectors", "deal_types_observed", "sectors_touched",
        "first_transaction_date", "most_recent_transaction_date",
        F.when(span.isNull() | (span == 0), F.lit(None).cast("double"))
        .otherwise(F.col("deal_count").cast("double") / span)
        .alias("avg_deals_per_active_year"),
        # Exact, engine-independent hash inputs: decimal sums and counts
        # rather than the floating-point averages derived from them.
        F.md5(F.concat_ws(
            "||",
            F.col("deal_count").cast("string"),
            F.coalesce(F.col("_vol").cast("string"), F.lit("")),
            F.coalesce(F.col("_e_sum").cast("string"), F.lit("")), F.col("_e_n").cast("string"),
            F.coalesce(F.col("_r_sum").cast("string"), F.lit("")), F.col("_r_n").cast("string"),
            F.col("distinct_target_sectors").cast("string"),
            F.coalesce(F.col("deal_types_observed"), F.lit("")),
            F.coalesce(F.col("sectors_touched"), F.lit("")),
            F.coalesce(F.col("first_transaction_date").cast("string"), F.lit("")),
            F.coalesce(F.col("most_recent_transaction_date").cast("string"), F.lit("")),
            F.coalesce(span.cast("string"), F.lit("")),
        )).alias("row_content_hash"),
    )


def dim_acquirer_activity(tx: DataFrame, dim_target: DataFrame, dim_acquirer: DataFrame,
                          run_ts: dt.datetime, small: int | None = None) -> DataFrame:
    return named_activity(activity_measures(tx, dim_target, small), dim_acquirer, run_ts)


def named_activity(m: DataFrame, dim_acquirer: DataFrame, run_ts: dt.datetime) -> DataFrame:
    names = dim_acquirer.select(F.col("acquirer_id").alias("_aq_id"), "acquirer_name", "acquirer_type")
    j = m.join(names, F.col("_aq_id") == F.col("acquirer_id"), "left")
    return j.select(
        *[c for c in ACTIVITY_COLUMNS if c not in ("dw_updated_at", "data_date")],
        F.lit(run_ts).cast("timestamp").alias("dw_updated_at"),
        _stamp(run_ts.date()).alias("data_date"),
    )


def report_partials(tx: DataFrame) -> DataFrame:
    """Partial sums and counts per target and year; they add up, and can be taken back."""
    closed = F.col("outcome").ilike("Closed%")
    pending = F.col("outcome").ilike("Pending%")
    return tx.filter(F.col("target_id").isNotNull()).groupBy("target_id", "deal_year").agg(
        F.count(F.lit(1)).alias("n"),
        fixed_sum_exact("deal_size_mm").alias("s"),
        F.count("deal_size_mm").alias("sn"),
        fixed_sum_exact("ev_ebitda_multiple").alias("es"),
        F.count("ev_ebitda_multiple").alias("en"),
        fixed_sum_exact("ev_revenue_multiple").alias("rs"),
        F.count("ev_revenue_multiple").alias("rn"),
        F.count_if(closed).alias("c"),
        F.count_if(pending).alias("p"),
    )


def report_of(partials: DataFrame, dim_target: DataFrame, data_date: dt.date) -> DataFrame:
    j = partials.join(
        dim_target.select(F.col("target_id").alias("_tg_id"), "sector"),
        F.col("_tg_id") == F.col("target_id"), "inner",
    )
    g = j.groupBy("sector", "deal_year").agg(
        F.sum("n").alias("transaction_count"),
        F.when(F.sum("sn") > 0, F.sum("s").cast("double")).alias("total_deal_size_mm"),
        avg_from_parts(F.sum("es"), F.sum("en")).alias("avg_ev_ebitda_multiple"),
        avg_from_parts(F.sum("rs"), F.sum("rn")).alias("avg_ev_revenue_multiple"),
        F.sum("c").alias("closed_deal_count"),
        F.sum("p").alias("pending_deal_count"),
    )
    # The report is small (sectors x years); its published order is part of it.
    return (g.withColumn("data_date", _stamp(data_date)).select(*REPORT_COLUMNS)
            .orderBy(F.col("sector").asc_nulls_last(), F.col("deal_year").asc_nulls_last()))


def stamped(rows: DataFrame, data_date: dt.date) -> DataFrame:
    """The same rows, of another day."""
    return rows.withColumn("data_date", _stamp(data_date)).select(*rows.columns)


def rpt_sector_trend_summary(tx: DataFrame, dim_target: DataFrame, data_date: dt.date) -> DataFrame:
    return report_of(report_partials(tx), dim_target, data_date)


# Tie-breakers after (announce_date, transaction_id) so that repeated ids
# still get a reproducible sequence on every engine and every retry.
SEQUENCE_TIEBREAK = ["acquirer_id", "close_date", "outcome", "deal_size_mm", "ev_ebitda_multiple",
                     "ev_revenue_multiple", "deal_year", "deal_quarter", "deal_type", "financing_type",
                     "num_bidders", "days_to_close"]


def fct_target_deal_sequence(tx: DataFrame, dim_target: DataFrame, data_date: dt.date,
                             small: int | None = None) -> DataFrame:
    """With ``small``, targets of at most so many deals are numbered by one window (``sequence_parts``)."""
    deals = tx.filter(F.col("target_id").isNotNull()).select(
        "transaction_id", "target_id", "acquirer_id", "announce_date", "close_date", "deal_year",
        "deal_quarter", "deal_type", "financing_type", "deal_size_mm", "ev_ebitda_multiple",
        "ev_revenue_multiple", "outcome", "num_bidders", "days_to_close",
    )
    order = ["announce_date", "transaction_id", *SEQUENCE_TIEBREAK]
    if small is None:
        return _sequence_shown(sequence_with_prior(deals, "target_id", order, LAGGED_COLUMNS, "deal_sequence_number"),
                               dim_target, data_date)
    few, many = sequence_parts(deals, "target_id", order, LAGGED_COLUMNS, "deal_sequence_number", small=small)
    # Each part is joined by itself: the first lies by target already.
    return _sequence_shown(few, dim_target, data_date).unionByName(_sequence_shown(many, dim_target, data_date))


def _with_names(rows: DataFrame, dim_target: DataFrame) -> DataFrame:
    return rows.join(
        dim_target.select(F.col("target_id").alias("_tg_id"), "target_name",
                          F.col("sector").alias("target_sector")),
        F.col("_tg_id") == F.col("target_id"), "left",
    )


def renamed_sequence(timeline: DataFrame, dim_target: DataFrame, data_date: dt.date) -> DataFrame:
    """The timeline of the same deals with what ``dim_target``, of unique keys, now says of their targets."""
    rows = _with_names(timeline.drop("target_name", "target_sector"), dim_target)
    return rows.withColumn("data_date", _stamp(data_date)).select(*SEQUENCE_COLUMNS)


def _sequence_shown(rows: DataFrame, dim_target: DataFrame, data_date: dt.date) -> DataFrame:
    lagged = _with_names(rows, dim_target)
    both = lambda a, b: F.col(a).isNotNull() & F.col(b).isNotNull()
    out = lagged.withColumns({
        "days_since_prior_announce": F.when(
            both("prior_announce_date", "announce_date"),
            F.datediff("announce_date", "prior_announce_date").cast("bigint")),
        "deal_size_mm_delta_vs_prior": F.when(
            both("prior_deal_size_mm", "deal_size_mm"),
            F.col("deal_size_mm") - F.col("prior_deal_size_mm")),
        "ev_ebitda_multiple_delta_vs_prior": F.when(
            both("prior_ev_ebitda_multiple", "ev_ebitda_multiple"),
            F.col("ev_ebitda_multiple") - F.col("prior_ev_ebitda_multiple")),
        "same_acquirer_as_prior": F.col("prior_acquirer_id").isNotNull()
        & (F.col("acquirer_id") == F.col("prior_acquirer_id")),
        "data_date": _stamp(data_date),
    })
    return out.select(*SEQUENCE_COLUMNS)
