"""A refresh after a change does the work of the change; models taken in one step equal those in slices."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from dealhouse.model import RUN_TS
from dealhouse.operators import staging as stg
from dealhouse.operators.merge import DuplicateKeyError
from dealhouse.operators.sequence import sequence_parts, sequence_with_prior
from dealhouse.plans import marts
from dealhouse.plans import pipeline as pl
from dealhouse.plans.warehouse import Warehouse
from dealhouse.session import scratch_dir
from dealhouse.sources.csv import write_csv

LATER = RUN_TS + dt.timedelta(days=1)
DAY = dt.date(1996, 3, 1)


def texts(spark, columns, rows):
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], ", ".join(f"{c} string" for c in columns))


@pytest.fixture()
def src(spark):
    """CSV sources of 30 deals of four targets and three buyers, one of them unknown."""
    path = scratch_dir(spark, "src")
    sources = {
        "acquirers": [{"acquirer_id": f"ACQ-{i}", "acquirer_name": f"buyer {i}"} for i in range(2)],
        "targets": [{"target_id": f"TGT-{i}", "target_name": f"target {i}", "sector": f"S{i % 2}"} for i in range(4)],
        "transactions": [{
            "transaction_id": f"TXN-{i}", "target_id": f"TGT-{i % 4}", "acquirer_id": f"ACQ-{i % 3}", "deal_type": "T",
            "announce_date": f"199{i % 5}-01-0{1 + i % 9}", "deal_year": f"199{i % 5}", "deal_quarter": "Q1",
            "deal_size_mm": str(i)} for i in range(30)],
        "acquirer_financials": [{"acquirer_id": "ACQ-1", "fiscal_year": "1996", "revenue_mm": "1.5"}],
        "sector_multiples": [{"sector": "S1", "fiscal_year": "1996", "fiscal_quarter": "Q1", "median_ev_ebitda": "2"}]}
    columns = {"acquirers": stg.ACQUIRER_COLUMNS, "targets": stg.TARGET_COLUMNS, "transactions": stg.TRANSACTION_COLUMNS,
               "acquirer_financials": stg.FINANCIAL_COLUMNS, "sector_multiples": stg.MULTIPLE_COLUMNS}
    for n, rows in sources.items():
        write_csv(texts(spark, columns[n], rows).coalesce(1), f"{path}/{n}")
    return path


def shown(wh):
    """All rows of the three models."""
    tables = (wh.read("analytics", "dim_acquirer_activity"), wh.read("analytics", "rpt_sector_trend_summary"), pl.read_timeline(wh))
    return [sorted(map(str, t.collect())) for t in tables]


def send_targets(spark, src, **changes):
    rows = [{"target_id": f"TGT-{i}", "target_name": f"target {i}", "sector": f"S{i % 2}"} for i in range(4)]
    rows[1].update(changes)
    write_csv(texts(spark, stg.TARGET_COLUMNS, rows).coalesce(1), f"{src}/targets")


@pytest.mark.parametrize("changes", [{"target_name": "Renamed"}, {"sector": "S0"}, {"employee_count": "7"}])
def test_models_after_a_change_of_targets_equal_those_made_anew(spark, src, changes, monkeypatch):
    wh, whole = (Warehouse(spark, scratch_dir(spark, "wh")) for _ in range(2))
    for w in (wh, whole):
        pl.incremental_refresh(w, src, RUN_TS)
    send_targets(spark, src, **changes)
    made = []
    with monkeypatch.context() as m:
        for name in ("fct_target_deal_sequence", "report_partials", "activity_measures"):
            m.setattr(marts, name, lambda *a, f=getattr(marts, name), n=name, **k: made.append(n) or f(*a, **k))
        out = pl.incremental_refresh(wh, src, LATER)
    # Deals are not numbered again, and aggregated only for a sector that changed.
    assert set(made) == ({"report_partials", "activity_measures"} if "sector" in changes else set())
    with monkeypatch.context() as m:
        m.setattr(pl, "refresh_affected_marts", pl.refresh_marts)
        again = pl.incremental_refresh(whole, src, LATER)
    assert shown(wh) == shown(whole) and out == again
    assert {r["data_date"] for r in pl.read_timeline(wh).collect()} == {LATER.date()}


def test_a_change_of_deals_or_of_buyers_twice_in_the_rollup_is_seen(spark, src):
    wh = Warehouse(spark, scratch_dir(spark, "wh"))
    pl.incremental_refresh(wh, src, RUN_TS)
    deals = wh.read("raw", "transactions").filter("transaction_id <> 'TXN-7'")
    write_csv(deals.coalesce(1), f"{src}/transactions")
    pl.incremental_refresh(wh, src, LATER)
    assert pl.read_timeline(wh).filter("transaction_id = 'TXN-7'").count() == 0 and pl.read_timeline(wh).count() == 29
    buyers = Warehouse(spark, scratch_dir(spark, "wh"))
    write_csv(wh.read("raw", "acquirers").unionByName(wh.read("raw", "acquirers")).coalesce(1), f"{src}/acquirers")
    pl.incremental_refresh(buyers, src, RUN_TS)
    send_targets(spark, src, target_name="Renamed")
    with pytest.raises(DuplicateKeyError):
        pl.incremental_refresh(buyers, src, LATER)


def test_rows_of_another_width_are_set_apart_and_none_need_no_second_scan(spark, src, monkeypatch):
    wh = Warehouse(spark, scratch_dir(spark, "wh"))
    scanned, write = {}, wh.write
    monkeypatch.setattr(wh, "write", lambda layer, name, df, **k: scanned.update(
        {name: "FileScan" in df._jdf.queryExecution().executedPlan().toString()}) or write(layer, name, df, **k))
    fs, path = wh._path(f"{src}/targets/extra.csv")
    wh._write_text(f"{src}/targets/extra.csv", ",".join(stg.TARGET_COLUMNS) + "\nTGT-9,short\n")
    assert fs.exists(path)
    out = pl.land_csv_sources(wh, src, ["acquirers", "targets"])
    assert out == {"raw.acquirers": 2, "raw.acquirers_rejected": 0, "raw.targets": 4, "raw.targets_rejected": 1}
    assert [tuple(r) for r in wh.read("raw", "targets_rejected").collect()] == [("TGT-9", "TGT-9,short")]
    assert wh.read("raw", "acquirers_rejected").columns == ["first_field", "line"]
    assert scanned == {"acquirers": True, "acquirers_rejected": False, "targets": True, "targets_rejected": True}


def test_small_sources_come_as_many_files(spark):
    from dealhouse.queries import REGISTRY

    root = scratch_dir(spark, "tables")
    put = lambda name, schema, rows: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    put("orders", "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
        "o_orderpriority string", [(3, 1, "F", 100.0, dt.datetime(1996, 3, 1), "1-URGENT")])
    put("lineitem", "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
        [(3, 1, 7, 1, 2.0, 800.0, 0.1, 0.0, "R", "O", dt.datetime(1996, 3, 1))])
    put("customer", "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        [(i, f"b{i}", 1, 5.0, "AUTO") for i in range(1, 41)])
    put("part", "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        [(i, f"t{i}", "B1", "T", 5, 10.0) for i in range(1, 41)])
    put("nation", "n_nationkey int, n_name string, n_regionkey int", [(1, "N", 1)])
    sent, write = {}, write_csv
    with pytest.MonkeyPatch.context() as m:
        m.setattr("dealhouse.sources.csv.write_csv", lambda df, path, mode="overwrite": sent.setdefault(
            path.rsplit("/", 1)[-1], df.rdd.getNumPartitions()) and write(df, path, mode))
        rows = REGISTRY["incremental_refresh"](spark, root).collect()
    assert sent["acquirers"] == sent["targets"] == spark.sparkContext.defaultParallelism
    assert len(rows) == 40 and sum(r["target_name"].endswith(" Holdings") for r in rows) == 8


def deals(spark):
    n = F.col("id")
    return spark.range(600).select(
        F.when(n % 3 == 0, F.lit("big")).when(n % 50 != 1, F.concat(F.lit("g"), (n % 97).cast("string"))).alias("acquirer_id"),
        F.concat(F.lit("T"), (n % 5).cast("string")).alias("target_id"),
        F.when(n % 7 != 0, F.date_add(F.lit(DAY), (n % 4).cast("int"))).alias("announce_date"),
        F.when(n % 11 != 0, F.concat(F.lit("TXN-"), (n % 200).cast("string"))).alias("transaction_id"),
        F.when(n % 13 > 2, (n % 6).cast("string")).when(n % 13 == 2, F.lit("")).alias("deal_type"),
        F.when(n % 5 != 0, (n % 3 + 1994).cast("int")).alias("deal_year"),
        F.when(n % 4 != 0, n / 7).alias("deal_size_mm"), F.lit(None).cast("double").alias("ev_ebitda_multiple"),
        (n / 3).alias("ev_revenue_multiple"), n.alias("tie"))


@pytest.mark.parametrize("small", [0, 15, 1000])
def test_groups_of_any_size_are_numbered_alike(spark, small):
    rows = deals(spark).filter("acquirer_id IS NOT NULL")
    args = ("acquirer_id", ["announce_date", "transaction_id", "tie"], ["transaction_id", "announce_date"], "rn")
    few, many = sequence_parts(rows, *args, small=small)
    held = few.select("acquirer_id").distinct().count(), many.select("acquirer_id").distinct().count()
    assert (held[0] == 0) == (small == 0) and (held[1] == 0) == (small == 1000)
    cols = ["acquirer_id", "tie", "rn", "prior_transaction_id", "prior_announce_date"]
    want = sequence_with_prior(rows, *args).select(cols)
    assert sorted(map(str, few.unionByName(many).select(cols).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("small", [0, 15, 1000])
def test_rollups_of_any_size_are_alike(spark, small):
    targets = spark.createDataFrame([("T0", "Unknown"), ("T1", "S"), ("T2", None), ("T3", "S")], "target_id string, sector string")
    want = marts.activity_measures(deals(spark), targets)
    got = marts.activity_measures(deals(spark), targets, small)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
