import datetime as dt

from pyspark.sql import functions as F

import json
import re

import pytest

import __spark_entry__ as entry
from dealhouse.model import RUN_TS, Model
from dealhouse.operators import staging as stg
from dealhouse.plans import changelog, marts, states
from dealhouse.plans import pipeline as pl
from dealhouse.plans.warehouse import Warehouse
from dealhouse.session import scratch_dir
from dealhouse.sources.csv import write_csv
from dealhouse.sources import deal_files
from dealhouse.streaming.ingest import rejected, stream_ingest, withdraw_deals

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    """The raw views, derived once and read from files since."""
    m, path = Model(spark, SF), scratch_dir(spark, "raw")
    for n in stg.STAGERS:
        m.raw(n).write.parquet(f"{path}/{n}")
    return {n: spark.read.parquet(f"{path}/{n}") for n in stg.STAGERS}


@pytest.fixture(scope="module")
def sources(spark, raw):
    """The same as CSV sources."""
    src = scratch_dir(spark, "sources")
    for n, df in raw.items():
        write_csv(df.coalesce(1), f"{src}/{n}")
    return src


def copied(wh, source, names=tuple(stg.STAGERS)):
    """A copy of the CSV sources that a test may change."""
    target = scratch_dir(wh.spark, "src")
    conf, path = wh.spark._jsc.hadoopConfiguration(), wh.spark._jvm.org.apache.hadoop.fs.Path
    for n in names:
        fs, a = wh._path(f"{source}/{n}")
        wh.spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, a, fs, path(f"{target}/{n}"), False, conf)
    return target


@pytest.fixture(scope="module")
def refreshed(spark, raw):
    """A fully refreshed warehouse, not to be changed."""
    wh = Warehouse(spark, scratch_dir(spark, "wh"))
    return wh, pl.refresh(wh, raw, RUN_TS)


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == entry.entry(spark).columns


def test_every_query_has_oracle_or_is_rows_only():
    trained = {n for n in entry.queries() if n == "pipeline" or n.startswith("op")}  # held against brute force
    assert set(entry.queries()) - set(entry.oracle_sql()) <= trained


def test_full_refresh_rerun_and_invariants(spark, raw, refreshed):
    wh, first = refreshed
    assert first["staging.transactions"] + first["staging.transactions_quarantine"] == first["raw.transactions"]
    fact_rows = pl.read_fact(wh).count()
    assert fact_rows == first["analytics.fct_transactions"]
    outside = pl.staged_transactions(wh).filter("deal_year IS NULL OR deal_year NOT BETWEEN 1990 AND 2035").count()
    assert outside > 0 and fact_rows + outside == first["staging.transactions"]
    report = wh.read("analytics", "rpt_sector_trend_summary").agg(F.sum("transaction_count")).first()[0]
    known = pl.staged_transactions(wh).join(wh.read("analytics", "dim_target"), "target_id").count()
    assert report == known
    # a run over the same staging, later: every dimension row keeps its stamps
    pl.refresh_dimensions(wh, RUN_TS + dt.timedelta(days=3))
    dates = {r[0] for r in wh.read("analytics", "dim_target").select("data_date").distinct().collect()}
    assert dates == {RUN_TS.date()}


def landed(spark, raw, deals):
    wh = Warehouse(spark, scratch_dir(spark, "wh"))
    pl.land_raw(wh, {**raw, "transactions": deals})
    pl.refresh_core(wh, RUN_TS)
    pl.refresh_fact(wh, RUN_TS)
    return wh


def fact_of(wh, deals):
    return marts.fct_transactions(
        deals, wh.read("analytics", "dim_target"), wh.read("analytics", "dim_acquirer"),
        wh.read("staging", "sector_multiples"), wh.read("staging", "acquirer_financials"), RUN_TS.date())


def test_batch_and_stream_feed_one_fact(spark, raw, refreshed):
    """Most deals by batch, some by stream, one micro-batch with bad rows only: all tables agree."""
    deals = raw["transactions"]
    bad = F.coalesce(F.trim("transaction_id"), F.lit("")) == ""
    streamed = F.col("announce_date").endswith("1")
    lone = deals.groupBy("transaction_id").count().filter("count = 1").select("transaction_id")
    streamed_deals = deals.filter(~bad & streamed).join(lone, "transaction_id", "left_semi").select(*deals.columns)
    wh = landed(spark, raw, deals.filter(~bad).exceptAll(streamed_deals))
    before = pl.read_fact(wh).count()
    src, ckpt = scratch_dir(spark, "stream"), scratch_dir(spark, "ckpt")
    write_csv(deals.filter(bad).coalesce(1), f"{src}/bad")
    write_csv(streamed_deals.repartition(2), f"{src}/good")
    assert stream_ingest(wh, f"{src}/*", ckpt, RUN_TS, max_files_per_trigger=1) == 3
    assert stream_ingest(wh, f"{src}/*", ckpt, RUN_TS) == 0  # nothing new: no batch
    whole, _ = refreshed
    assert 0 < before < pl.read_fact(wh).count() and rejected(wh).count() == 0
    assert rows_of(pl.read_fact(wh)) == rows_of(pl.read_fact(whole))
    same_marts(wh, whole)
    # compaction changes where the rows lie, not which there are
    deals = pl.staged_transactions(wh)
    had = rows_of(deals)
    changelog.compact(wh, pl.batch_deals(wh).schema, max_batches=1)
    assert not changelog.batches(wh) and changelog.last_batch(wh) == 2
    assert rows_of(pl.staged_transactions(wh)) == had


DEAL = {c: None for c in stg.TRANSACTION_COLUMNS} | {"target_id": "TGT-1", "acquirer_id": "ACQ-1", "outcome": "Pending"}


def deal_rows(spark, *deals):
    return spark.createDataFrame([tuple((DEAL | d)[c] for c in stg.TRANSACTION_COLUMNS) for d in deals],
                                 ", ".join(f"{c} string" for c in stg.TRANSACTION_COLUMNS))


def deal(n, year, size="10", **more):
    return {"transaction_id": f"TXN-{n}", "deal_year": str(year), "deal_size_mm": size, **more}


def held(wh):
    """(id, year, size) of the fact, which must say what staging says."""
    got = sorted(tuple(r) for r in pl.read_fact(wh).select("transaction_id", "deal_year", "deal_size_mm").collect())
    assert rows_of(fact_of(wh, pl.staged_transactions(wh))) == rows_of(pl.read_fact(wh))
    return got


def put(wh, dimension, df):
    """The rows of a dimension, whatever it held."""
    key = df.columns[0]
    wh.replace_partitions("analytics", dimension, pl._in_buckets(df, [key]), pl.HIDDEN_BUCKET, only=True)


def same_marts(a, b):
    assert rows_of(a.read("analytics", "rpt_sector_trend_summary")) == rows_of(b.read("analytics", "rpt_sector_trend_summary"))
    assert rows_of(pl.read_timeline(a)) == rows_of(pl.read_timeline(b))
    drop = ("dw_updated_at", "data_date")
    assert rows_of(a.read("analytics", "dim_acquirer_activity").drop(*drop)) == rows_of(
        b.read("analytics", "dim_acquirer_activity").drop(*drop))


def test_states_equal_the_full_models_after_three_batches(spark, raw):
    """Corrections move deals between buyers, targets, years; one target changes its sector between batches."""
    deals = raw["transactions"]
    wh = landed(spark, raw, deals.filter("deal_quarter <> 'Q4'"))
    src, ckpt, keep = scratch_dir(spark, "stream"), scratch_dir(spark, "ckpt"), F.length("transaction_id") > 3
    one = deals.filter(keep & (F.col("deal_quarter") == "Q2"))
    for name, df in {"a": deals.filter("deal_quarter = 'Q4'"), "b": one.withColumns({
            "acquirer_id": F.lit("ACQ-7"), "deal_size_mm": F.lit(None).cast("string"), "announce_date": F.lit("1997-02-03")}),
            "c": one.withColumns({"target_id": F.lit("TGT-9"), "deal_year": F.lit("1993"), "outcome": F.lit("Pending vote")})}.items():
        write_csv(df.coalesce(1), f"{src}/{name}")
        stream_ingest(wh, f"{src}/*", ckpt, RUN_TS)
        if name == "b":
            wh.write("raw", "targets", raw["targets"].withColumn("sector", F.when(
                F.col("target_id").endswith("5"), F.lit("Moved")).otherwise(F.col("sector"))))
            pl.refresh_staging(wh, ["targets"])
            pl.refresh_dimensions(wh, RUN_TS, ["targets"])
    full = Warehouse(spark, scratch_dir(spark, "wh"))
    for layer, name in (("staging", "transactions"), ("analytics", "dim_target"), ("analytics", "dim_acquirer")):
        rows = pl._by_year(pl.staged_transactions(wh)) if name == "transactions" else wh.read(layer, name)
        if layer == "staging":
            full.write(layer, name, rows, partition_by=[pl.YEAR_FOLDER])
        else:
            put(full, name, rows)
    pl.refresh_marts(full, RUN_TS)
    gone = wh.read("analytics", "dim_acquirer_activity").join(full.read("analytics", "dim_acquirer_activity"), "acquirer_id", "left_anti")
    put(full, "dim_acquirer_activity", full.read("analytics", "dim_acquirer_activity").unionByName(
        wh.read("analytics", "dim_acquirer_activity").join(gone, "acquirer_id", "left_semi")))  # a merge deletes nothing
    same_marts(wh, full)


def test_a_small_change_touches_its_own_buckets(spark, raw):
    small = {n: df.limit(5) for n, df in raw.items()}
    wh = landed(spark, small, deal_rows(spark, *[deal(i, 2001, target_id=f"TGT-{i}", acquirer_id=f"ACQ-{i}") for i in range(40)]))
    src, ckpt = scratch_dir(spark, "stream"), scratch_dir(spark, "ckpt")
    write_csv(deal_rows(spark, deal(50, 2001, target_id="TGT-50", acquirer_id="ACQ-50")).coalesce(1), f"{src}/a")
    stream_ingest(wh, f"{src}/*", ckpt, RUN_TS)
    before = {t: wh.partition_versions("state", t) for t in states.KEYS}
    write_csv(deal_rows(spark, deal(3, 2001, "77", target_id="TGT-3", acquirer_id="ACQ-3")).coalesce(1), f"{src}/b")
    stream_ingest(wh, f"{src}/*", ckpt, RUN_TS)
    for t in states.KEYS:
        after = wh.partition_versions("state", t)
        assert sum(after[b] != before[t][b] for b in after) == 1
    batch = changelog.last_batch(wh)
    rows = rows_of(wh.read_parts("state", "report"))
    states.apply_batch(wh, pl.staged_transactions(wh), pl.staged_transactions(wh), batch)  # run again: nothing
    assert rows_of(wh.read_parts("state", "report")) == rows
    plan = wh.read_parts("state", "deals", [1, 2])
    assert {f.split("bucket=")[1].split("/")[0] for f in plan.inputFiles()} <= {"1", "2"}


def test_the_last_writer_of_a_deal_wins(spark, raw, monkeypatch):
    small = {n: df.limit(5) for n, df in raw.items()}
    wh = landed(spark, small, deal_rows(spark, deal(1, 2001), deal(2, 2001), deal(3, 2002), deal(3, 2002, "11"), deal(4, 2003)))
    src, ckpt = scratch_dir(spark, "stream"), scratch_dir(spark, "ckpt")

    def send(name, *deals):
        write_csv(deal_rows(spark, *deals).coalesce(1), f"{src}/{name}")

    def drain():
        stream_ingest(wh, f"{src}/*", ckpt, RUN_TS)

    send("a", deal(1, 2005, "20"), deal(3, 2002, "30"), deal(9, 2004), deal(9, 2004, "91"))
    drain()  # a deal moves to another year, two rows of one id become one, the last row of a file wins
    assert held(wh) == [("TXN-1", 2005, 20.0), ("TXN-2", 2001, 10.0), ("TXN-3", 2002, 30.0), ("TXN-4", 2003, 10.0), ("TXN-9", 2004, 91.0)]
    send("b", deal(1, 2001, "21"), deal(9, 2525))
    withdraw_deals(wh, spark.createDataFrame([(" txn-4",), ("TXN-77",), ("",)], "transaction_id string"), f"{src}/gone")
    drain()  # corrected again, out of the domain, and withdrawn
    assert held(wh) == [("TXN-1", 2001, 21.0), ("TXN-2", 2001, 10.0), ("TXN-3", 2002, 30.0)]
    send("c", deal(4, 2003, "44"), deal(2, 2001, "-1"))  # a negative size is quarantined and replaces nothing
    real = pl.refresh_fact

    def dies(*args, **kwargs):
        monkeypatch.setattr(pl, "refresh_fact", real)
        raise RuntimeError("lost")

    monkeypatch.setattr(pl, "refresh_fact", dies)
    with pytest.raises(Exception, match="lost"):
        drain()
    drain()  # the batch is run again, with its log folder written already
    assert held(wh) == [("TXN-1", 2001, 21.0), ("TXN-2", 2001, 10.0), ("TXN-3", 2002, 30.0), ("TXN-4", 2003, 44.0)]
    # a later landing is a later write for the ids that it has; others stay as the stream left them
    wh.write("raw", "transactions", deal_rows(spark, deal(1, 2006, "1"), deal(2, 2001), deal(9, 2004, "9")))
    pl.refresh_staging(wh, ["transactions"])
    assert changelog.pending_years(wh)
    pl.refresh_affected(wh, RUN_TS)
    assert held(wh) == [("TXN-1", 2006, 1.0), ("TXN-2", 2001, 10.0), ("TXN-3", 2002, 30.0), ("TXN-4", 2003, 44.0), ("TXN-9", 2004, 9.0)]
    assert not changelog.pending_years(wh)
    send("d", deal(1, 2001, "5"))
    drain()  # and the stream may write after that again
    assert held(wh)[0] == ("TXN-1", 2001, 5.0)


def test_deal_files_are_read_by_their_headers(spark, local_dir):
    head = ["id", "name", "size"]
    texts = {"order.csv": "size,id,name\n1,A,x\n", "lines.csv": 'id,name,size\nB,"two\nlines, ""quoted""",2\nC,,\n',
             "wide.csv": "id,name,size\nD,x,3,extra\nE,y,4\n", "short.csv": "id,name,size\nF,x\n\nG,z,5\n",
             "other.csv": "id,name,amount\nH,x,6\n", "narrow.csv": "id,name\nI,x\n", "double.csv": "id,id,size\nJ,K,7\n",
             "bom.csv": "\ufeffID, Name ,SIZE\nL,x,8\n", "bare.csv": "id,name,size\n", "nothing.csv": ""}
    for name, text in texts.items():
        with open(f"{local_dir}/{name}", "w") as f:
            f.write(text)
    records = deal_files.fields_of(spark, [f"{local_dir}/{n}" for n in texts], 3)
    good, bad = deal_files.split_rows(records, head)
    assert sorted(tuple(r) for r in good.select(*head).collect()) == [
        ("A", "x", "1"), ("B", 'two\nlines, "quoted"', "2"), ("C", None, None), ("E", "y", "4"), ("G", "z", "5"), ("L", "x", "8")]
    got = sorted((r["file"].rsplit("/", 1)[1], r["reason"], r["line"]) for r in bad.collect())
    assert got == [("double.csv", "wrong_header", "J,K,7"), ("narrow.csv", "wrong_header", "I,x"), ("other.csv", "wrong_header", "H,x,6"),
                   ("short.csv", "wrong_width", "F,x"), ("wide.csv", "wrong_width", "D,x,3,extra")]


def test_change_during_a_refresh_is_seen_by_the_next(spark, raw, sources, monkeypatch):
    wh = Warehouse(spark, scratch_dir(spark, "wh"))
    src = copied(wh, sources)
    write_csv(raw["targets"].limit(1), f"{src}/transactions_incoming")  # a stream's folder: no source
    real = pl.refresh_staging

    def rewritten_meanwhile(*args, **kwargs):
        renamed = raw["targets"].withColumn("target_name", F.concat("target_name", F.lit(" NEW")))
        write_csv(renamed, f"{src}/targets")
        return real(*args, **kwargs)

    monkeypatch.setattr(pl, "refresh_staging", rewritten_meanwhile)
    first = pl.incremental_refresh(wh, src, RUN_TS)
    assert first["raw.transactions"] == raw["transactions"].count()
    monkeypatch.setattr(pl, "refresh_staging", real)
    assert not wh.read("staging", "targets").filter(F.col("target_name").endswith("NEW")).count()
    later = RUN_TS + dt.timedelta(days=1)
    second = pl.incremental_refresh(wh, src, later)
    assert "raw.targets" in second and "raw.transactions" not in second
    assert wh.read("staging", "targets").filter(~F.col("target_name").endswith("NEW")).count() == 0
    stamps = {r[0] for r in wh.read("analytics", "dim_target").select("data_date").distinct().collect()}
    assert stamps == {later.date()}    # every target renamed -> every row updated
    assert wh.read("analytics", "dim_acquirer").select("data_date").distinct().count() == 1
    write_csv(raw["targets"].limit(2), f"{src}/transactions_incoming")
    assert pl.incremental_refresh(wh, src, RUN_TS) == {}
    assert pl.affected_years(wh) == []


def test_only_touched_years_are_replaced(spark, raw, refreshed):
    """Each input changes in a few rows: the replaced years are those of the deals that show them."""
    whole, _ = refreshed
    wh = landed(spark, raw, raw["transactions"])
    versions = lambda: wh.partition_versions("analytics", pl.FACT_TABLE)

    def after(layer, table, df):
        before = versions()
        if layer == "analytics":
            put(wh, table, df)
        else:
            wh.write(layer, table, df)
        out = pl.refresh_affected(wh, RUN_TS)
        assert rows_of(pl.read_fact(wh)) == rows_of(fact_of(wh, pl.staged_transactions(wh)))
        moved = {y for y, v in versions().items() if before.get(y) != v}
        assert moved == {int(y) for y in re.findall(r"\[(\d+)\]", json.dumps(list(out)))}
        return moved

    fact = pl.read_fact(wh)
    years = {r["target_id"]: set(r["ys"]) for r in fact.groupBy("target_id").agg(F.collect_set("deal_year").alias("ys")).collect()}
    targets = wh.read("analytics", "dim_target")
    names = {r["target_id"] for r in targets.select("target_id").collect()}
    one = min((t for t in years if t in names), key=lambda t: (len(years[t]), t))
    assert after("analytics", "dim_target", targets.withColumn("target_name", F.when(
        F.col("target_id") == one, F.lit("Renamed")).otherwise(F.col("target_name")))) == years[one]
    assert after("analytics", "dim_target", wh.read("analytics", "dim_target").withColumn("dw_updated_at", F.current_timestamp())) == set()
    money = wh.read("staging", "acquirer_financials")
    hit = fact.filter("acquirer_fiscal_revenue_mm IS NOT NULL").orderBy("transaction_id").first()
    touched = after("staging", "acquirer_financials", money.withColumn("net_debt_mm", F.when(
        (F.col("acquirer_id") == hit["acquirer_id"]) & (F.col("fiscal_year") == hit["announce_date"].year), F.lit(-1.0))
        .otherwise(F.col("net_debt_mm"))))
    assert hit["deal_year"] in touched and len(touched) == 1
    marks = wh.read("staging", "sector_multiples")
    mark = fact.filter("sector_median_ev_ebitda IS NOT NULL").orderBy("transaction_id").first()
    assert after("staging", "sector_multiples", marks.filter(~(
        (F.col("sector") == mark["target_sector"]) & (F.col("fiscal_year") == mark["deal_year"])))) == {mark["deal_year"]}
    wh.write("raw", "transactions", raw["transactions"].filter("deal_year <> '1996'"))
    before = versions()
    pl.refresh_staging(wh, ["transactions"])
    pl.refresh_affected(wh, RUN_TS)
    now = versions()
    assert 1996 not in now and {y: v for y, v in before.items() if y != 1996} == now


def test_a_reader_sees_one_version_at_a_time(spark, monkeypatch):
    """Read at every step of a replace that rewrites, adds and clears partitions."""
    wh = Warehouse(spark, scratch_dir(spark, "wh"))
    schema = "y int, v string"

    def frame(*rows):
        return spark.createDataFrame(list(rows), schema)

    def seen():
        return sorted(tuple(r) for r in wh.read_partitioned("analytics", "t", frame().schema, ["y", "v"], "y").collect())

    assert seen() == []
    assert wh.replace_partitions("analytics", "t", frame((1, "a"), (2, "a"), (2, "b"), (None, "z")), "y") == {1: 1, 2: 2}
    old, new = [(1, "a"), (2, "a"), (2, "b")], [(1, "a"), (3, "c")]
    assert seen() == old
    real, views = wh._put_next, []

    def watched(folder, text, after=None):
        views.append(seen())
        out = real(folder, text, after)
        views.append(seen())
        return out

    monkeypatch.setattr(wh, "_put_next", watched)
    assert wh.replace_partitions("analytics", "t", frame((3, "c"), (9, "no")), "y", [2, 3]) == {2: 0, 3: 1}
    assert views == [old, new] and wh.partition_rows("analytics", "t") == {1: 1, 3: 1}
    # a second writer that began before this one's manifest is refused, and nothing of it shows
    from dealhouse.plans.warehouse import ConcurrentReplace

    monkeypatch.setattr(wh, "_manifest", lambda *a: (1, {}))
    with pytest.raises(ConcurrentReplace):
        wh.replace_partitions("analytics", "t", frame((5, "late")), "y")
    monkeypatch.undo()
    assert seen() == new
    assert wh.replace_partitions("analytics", "t", frame((7, "x")), "y", [7], only=True) == {7: 1}
    assert seen() == [(7, "x")]


def test_a_merge_rewrites_only_buckets_with_changes(spark):
    """The bucketed upsert gives the rows of the plain merge, and leaves all other files alone."""
    from dealhouse.operators.merge import DuplicateKeyError, scd1_merge

    def rows(ids, name, day):
        return spark.createDataFrame(ids, "k string").select("k", F.lit(name).alias("name"), F.md5(F.lit(name)).alias(
            "row_content_hash"), F.lit(day).cast("date").alias("data_date"))

    wh, columns = Warehouse(spark, scratch_dir(spark, "wh")), ["k", "name", "row_content_hash", "data_date"]
    first = rows([(f"K{i}",) for i in range(500)] + [(None,)], "old", "2025-01-01")
    assert pl._merge_table(wh, "t", first, ["k"], columns) == 501
    versions = lambda: wh.partition_versions("analytics", "t")
    before = versions()
    assert pl._merge_table(wh, "t", rows([("K3",), ("K4",)], "old", "2025-01-02"), ["k"], columns) == 501
    assert versions() == before and wh.current_version("analytics", "t") == 1  # nothing differs: no new version
    source = rows([("K3",), ("K900",), (None,)], "new", "2025-01-02").unionByName(rows([("K5",)], "old", "2025-01-02"))
    assert pl._merge_table(wh, "t", source, ["k"], columns) == 502
    touched = {r[0] for r in pl._in_buckets(rows([("K3",), ("K900",), (None,)], "", "2025-01-01"), ["k"]).select(pl.HIDDEN_BUCKET).collect()}
    assert {b for b, v in versions().items() if before.get(b) != v} == touched
    assert wh.read("analytics", "t").columns == columns
    assert rows_of(wh.read("analytics", "t")) == rows_of(scd1_merge(first, source, ["k"], columns))
    assert rows_of(wh.read("analytics", "t", 1)) == rows_of(first)  # the version before can still be read
    with pytest.raises(DuplicateKeyError):
        pl._merge_table(wh, "t", rows([("A",), ("A",)], "x", "2025-01-03"), ["k"], columns)


def test_old_versions_go_unless_pinned_or_named(spark):
    wh = Warehouse(spark, scratch_dir(spark, "wh"), keep=1, retain_s=0)
    for i in range(3):
        wh.write("staging", "t", spark.range(i))
        if i == 0:
            wh.pin("consumer", {"staging.t": 1})
    assert wh.versions("staging", "t") == [1, 3] and wh.read("staging", "t", 1).count() == 0
    for y in (1, 2, 1):
        wh.replace_partitions("analytics", "p", spark.createDataFrame([(y,)], "y int").withColumn("v", F.lit(y)), "y")
    assert wh.partition_versions("analytics", "p") == {1: 3, 2: 2}
    assert sorted(wh.list_dir(f"{wh.root}/analytics/p/data")) == ["_data_version=000002", "_data_version=000003"]


def test_year_domain(spark):
    wh = Warehouse(spark, scratch_dir(spark, "wh"))
    with pytest.raises(ValueError, match="2525"):
        pl.refresh_fact(wh, RUN_TS, [2525])
