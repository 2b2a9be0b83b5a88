"""Queries over small driver tables of their own: nothing of the job is left out, and large parts are spread."""
import datetime as dt

import pytest

from dealhouse.queries import REGISTRY
from dealhouse.session import scratch_dir

DAY = dt.datetime(1996, 3, 1)


@pytest.fixture(scope="module")
def sf(spark):
    """Three orders: 228 gets the deal year 2525, 232 none, 3 its own; 3 has lines of two suppliers."""
    root = scratch_dir(spark, "tables")

    def put(name, schema, rows):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")

    put("orders", "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
        "o_orderpriority string", [(k, 1, "F", 100.0 * k, DAY, "1-URGENT") for k in (3, 228, 232)])
    line = lambda order, part, supplier, price, flag: (order, part, supplier, 1, 2.0, price, 0.1, 0.0, flag, "O", DAY)
    put("lineitem", "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp", [line(3, 1, 7, 800.0, "R"), line(3, 2, 8, 1600.0, "A"), line(3, 2, 8, 400.0, "N"),
                                 line(228, 1, 7, 200.0, "N")])
    put("customer", "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        [(1, "Buyer", 1, 5.0, "AUTO")])
    put("part", "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        [(1, "one", "B1", "T", 5, 10.0), (2, "two", "B1", "T", 6, 10.0)])
    put("nation", "n_nationkey int, n_name string, n_regionkey int", [(1, "N", 1)])
    put("region", "r_regionkey int, r_name string", [(1, "R")])
    return root


def test_the_fact_has_deals_of_any_year_and_without_one(spark, sf):
    years = {r["transaction_id"]: r["deal_year"] for r in REGISTRY["fct_transactions"](spark, sf).collect()}
    assert years == {"TXN-3": 1996, "TXN-228": 2525, "TXN-232": None}


def test_the_export_counts_deals_of_any_year(spark, sf):
    counts = {r["table_name"]: r["row_count"] for r in REGISTRY["export_csv_with_manifest"](spark, sf).collect()}
    assert counts["fct_transactions"] == 3


def test_lines_travel_once_to_their_order(spark, sf):
    deals = REGISTRY["raw_transactions"](spark, sf)
    plan = deals._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_orderkey" in plan and ", l_suppkey" not in plan.split("Exchange hashpartitioning(l_orderkey")[1][:30]
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1
    got = {r["transaction_id"]: r for r in deals.collect()}["TXN-3"]
    assert (got["target_id"], got["num_bidders"], got["financing_type"], got["ev_ebitda_multiple"]) == ("TGT-1", "2", "A", "2.3")


def test_quartiles_of_both_multiples(spark, sf):
    (row,) = REGISTRY["raw_sector_multiples"](spark, sf).collect()
    assert (row["median_ev_ebitda"], row["median_ev_revenue"], row["p75_ev_ebitda"], row["p75_ev_revenue"], row["deal_count"]) \
        == ("1.50", "0.38", "2.50", "0.63", "4")


@pytest.mark.parametrize("name", ["chk_csv_width", "export_csv_with_manifest"])
def test_deals_sent_in_parts_are_derived_once(spark, sf, monkeypatch, name):
    from dealhouse.sources import csv

    sent, write = [], csv.write_csv

    def recorded(df, path, mode="overwrite"):
        sent.append((path.rsplit("/", 1)[-1], {f.rsplit("/", 2)[-2] for f in df.inputFiles()}))
        return write(df, path, mode)

    monkeypatch.setattr(csv, "write_csv", recorded)
    REGISTRY[name](spark, sf).collect()
    # The benchmarks of the exported fact are the one input that is still read from the lines.
    assert not [to for to, tables in sent if "lineitem.parquet" in tables and to != "fct_transactions"]
    assert len(sent) == (15 if name == "chk_csv_width" else 3)


def test_records_of_a_large_file_stay_spread(spark):
    from pyspark.sql import functions as F

    from dealhouse.sources.deal_files import AT, FILE, LINE, split_rows

    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(0, 4000, 1, 4).select(
            F.lit("f").alias(FILE), F.col("id").alias(AT), F.when(F.col("id") == 0, F.array(F.lit("b"), F.lit("A "))).otherwise(
                F.array(F.lit("x"), F.col("id").cast("string"))).alias("fields"),
            F.when(F.col("id") % 10 == 9, F.lit("x,y,z")).alias(LINE))
        good, bad = split_rows(rows, ["a", "b"])
        parts = good.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(parts) == 4 and sum(r["count"] for r in parts) == 3599 and bad.count() == 400
        assert good.filter("a = cast(_at as string) AND b = 'x'").count() == 3599
    finally:
        from dealhouse.session import apply_conf
        apply_conf(spark)
