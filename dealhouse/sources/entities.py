"""Raw (all-string, deliberately dirty) deal entities derived from the driver
tables, so staging, quarantine and checks have real work at every scale.

Each view has the column set of one landed source file. Keys: orders become
transactions, customers acquirers, parts targets, (customer, year) order
totals acquirer financials and (brand, year, quarter) line prices sector
multiples. The ``k % m`` rules inject defects at fixed rates; they select
which rows are dirty, never which rows exist.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealhouse.sources.tables import DriverTables


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _dec_text(c: Column, scale_spec: str) -> Column:
    return c.cast(f"decimal({scale_spec})").cast("string")


def raw_transactions(t: DriverTables) -> DataFrame:
    # Lines travel once, as they are, to their order: both steps of the aggregation and the join with
    # orders work on that partitioning. Partial sums would be wider than the lines, an order has few.
    parts = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_discount",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("ext"),
        F.col("l_quantity").cast("decimal(18,2)").alias("qty"),
        # One-character codes: an integer min keeps the aggregation hash-based.
        F.ascii("l_returnflag").alias("rf_code"),
    ).repartition("l_orderkey")
    lines = parts.groupBy("l_orderkey").agg(
        F.min("l_partkey").alias("lead_part"),
        F.max("l_shipdate").alias("last_ship"),
        F.sum("ext").alias("ext"),
        F.sum("qty").alias("qty"),
        F.max("l_discount").alias("disc"),
        F.countDistinct("l_suppkey").alias("bidders"),
        F.min("rf_code").alias("rf_code"),
    )
    o = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    k = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    order_day = F.col("o_orderdate").cast("date")
    ship_day = F.col("last_ship").cast("date")
    unit_price = F.col("ext").cast("double") / F.col("qty").cast("double")
    return o.select(
        F.when(k % 211 == 0, F.lit("  "))
        .when(k % 13 == 0, F.concat(F.lit(" txn-"), _s(k), F.lit(" ")))
        .when(k % 499 == 1, F.concat(F.lit("TXN-"), _s(k - 1)))
        .otherwise(F.concat(F.lit("TXN-"), _s(k)))
        .alias("transaction_id"),
        F.when(k % 307 == 0, F.lit("TGT-MISSING"))
        .otherwise(F.concat(F.lit("TGT-"), _s("lead_part")))
        .alias("target_id"),
        F.when(k % 401 == 0, F.lit("ACQ-MISSING"))
        .otherwise(F.concat(F.lit("ACQ-"), _s("o_custkey")))
        .alias("acquirer_id"),
        F.when(k % 997 == 0, F.lit("2020"))
        .when(k % 7 == 0, F.regexp_replace(_s(order_day), "-", "/"))
        .otherwise(_s(order_day))
        .alias("announce_date"),
        F.when(status == "F", _s(ship_day)).otherwise(F.lit("")).alias("close_date"),
        F.when(k % 223 == 5, F.lit("2525")).when(k % 227 == 5, F.lit("")).otherwise(_s(F.year("o_orderdate")))
        .alias("deal_year"),
        F.concat(F.lit("Q"), _s(F.quarter("o_orderdate"))).alias("deal_quarter"),
        F.col("o_orderpriority").alias("deal_type"),
        F.when(F.col("rf_code").isNotNull(), F.chr(F.col("rf_code"))).alias("financing_type"),
        F.when(k % 97 == 0, F.lit("-5.5"))
        .when(k % 101 == 0, F.lit("n/a"))
        .otherwise(_dec_text(F.col("o_totalprice") / 100, "18,1"))
        .alias("deal_size_mm"),
        _dec_text(unit_price / 200, "18,1").alias("ev_ebitda_multiple"),
        _dec_text(unit_price / 800, "18,2").alias("ev_revenue_multiple"),
        _dec_text(F.col("disc") * 100, "18,1").alias("synergy_pct_of_deal"),
        F.when(status == "F", F.when(k % 2 == 0, F.lit("Closed")).otherwise(F.lit(" closed ")))
        .when(status == "P", F.lit("Pending"))
        .otherwise(F.lit("Rumored"))
        .alias("outcome"),
        F.lit("Scale;Synergy").alias("strategic_rationale_tags"),
        F.when(k % 89 == 0, F.lit("3.7")).otherwise(_s("bidders")).alias("num_bidders"),
        F.when(k % 83 == 0, F.lit(None).cast("string"))
        .when(status == "F", _s(F.datediff(ship_day, order_day)))
        .alias("days_to_close"),
    )


def raw_acquirers(t: DriverTables) -> DataFrame:
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    return c.select(
        F.when(k % 17 == 0, F.concat(F.lit(" acq-"), _s(k)))
        .otherwise(F.concat(F.lit("ACQ-"), _s(k)))
        .alias("acquirer_id"),
        F.concat(F.lit(" "), F.col("c_name")).alias("acquirer_name"),
        F.when(k % 4 == 0, F.lit("strategic"))
        .when(k % 4 == 1, F.lit(" Financial Sponsor"))
        .when(k % 4 == 2, F.lit("STRATEGIC"))
        .otherwise(seg)
        .alias("acquirer_type"),
        seg.alias("primary_sector_focus"),
        F.col("n_name").alias("headquarters"),
        F.when(k % 4 == 1, F.lit("Private"))
        .otherwise(F.concat(F.lit("NYSE: "), seg))
        .alias("ticker_or_status"),
        F.when(k % 53 == 0, F.lit("n/a")).otherwise(_s(k % 5000)).alias("employee_count"),
        _dec_text(F.col("c_acctbal"), "18,2").alias("annual_revenue_mm"),
        F.concat(_s(k % 60 + 1950), F.lit("/01/01")).alias("founded_date"),
        F.when(k % 3 == 0, F.lit("National")).otherwise(F.lit("Multi-Regional")).alias("geographic_reach"),
    )


def raw_targets(t: DriverTables) -> DataFrame:
    k = F.col("p_partkey")
    return t.part.select(
        F.concat(F.lit("tgt-"), _s(k)).alias("target_id"),
        F.col("p_name").alias("target_name"),
        F.concat(F.lit(" "), F.col("p_brand")).alias("sector"),
        F.col("p_type").alias("sub_sector"),
        F.lit("US").alias("geography"),
        F.when(k % 2 == 0, F.lit("Private")).otherwise(F.lit("PE-Backed")).alias("ownership_type"),
        F.concat(_s(k % 40 + 1980), F.lit("-6-1")).alias("founded_date"),
        _s("p_size").alias("employee_count"),
        _dec_text(F.col("p_retailprice"), "18,2").alias("ltm_revenue_mm"),
        _s(F.col("p_size") - 10).alias("ebitda_margin_pct"),
        F.when(k % 31 == 0, F.lit("NULL")).otherwise(_s(F.col("p_size") - 20)).alias("revenue_growth_pct"),
    )


def raw_acquirer_financials(t: DriverTables) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(18,2)")
    g = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("fy")).agg(
        F.sum(price).alias("rev"),
        F.min(price).alias("lo"),
        F.max(price).alias("hi"),
        F.count(F.lit(1)).alias("n"),
    )
    return g.select(
        F.concat(F.lit("ACQ-"), _s("o_custkey")).alias("acquirer_id"),
        _s("fy").alias("fiscal_year"),
        _s("rev").alias("revenue_mm"),
        _dec_text(F.col("rev") * F.lit(0.2).cast("decimal(1,1)"), "18,1").alias("ebitda_mm"),
        F.lit("20.0").alias("ebitda_margin_pct"),
        _s(F.col("lo") - 5000).alias("net_debt_mm"),
        _s("lo").alias("cash_on_hand_mm"),
        _s("hi").alias("total_assets_mm"),
        F.when(F.col("o_custkey") % 10 == 0, F.lit(None).cast("string")).otherwise(_s("hi")).alias("market_cap_mm"),
        _s("n").alias("employee_count"),
    )


def raw_sector_multiples(t: DriverTables) -> DataFrame:
    """Exact quartiles per (brand, year, quarter) of unit price.

    Rows are first reduced to (group, unit price, frequency) with a map-side
    combine, so a hot group is split across tasks before the exact
    ``percentile`` (weighted by frequency) sees one row per distinct price."""
    li = t.lineitem.select(
        "l_partkey",
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("v"),
        F.year("l_shipdate").alias("fy"),
        F.quarter("l_shipdate").alias("fq"),
    )
    joined = li.join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    freq = joined.groupBy("p_brand", "fy", "fq", "v").agg(F.count(F.lit(1)).alias("w"))
    qs = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    # Quartiles of v / 800 are a fourth of those of v / 200, to the bit: dividing by 4 rounds nothing.
    g = freq.groupBy("p_brand", "fy", "fq").agg(
        F.percentile(F.col("v") / 200, qs, F.col("w")).alias("e"),
        F.sum("w").alias("n"),
    ).withColumn("r", F.transform("e", lambda x: x / 4))

    def q(arr: str, i: int) -> Column:
        return _dec_text(F.col(arr)[i], "18,2")

    return g.select(
        F.concat(F.lit(" "), F.col("p_brand")).alias("sector"),
        _s("fy").alias("fiscal_year"),
        F.concat(F.lit("Q"), _s("fq")).alias("fiscal_quarter"),
        q("e", 1).alias("median_ev_ebitda"),
        q("e", 0).alias("p25_ev_ebitda"),
        q("e", 2).alias("p75_ev_ebitda"),
        q("r", 1).alias("median_ev_revenue"),
        q("r", 0).alias("p25_ev_revenue"),
        q("r", 2).alias("p75_ev_revenue"),
        _s("n").alias("deal_count"),
    )


RAW_BUILDERS = {
    "acquirers": raw_acquirers,
    "targets": raw_targets,
    "transactions": raw_transactions,
    "acquirer_financials": raw_acquirer_financials,
    "sector_multiples": raw_sector_multiples,
}
