"""Independent steps run at once, and models of ordinary groups take one step in the stream and the catalog too."""
import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from dealhouse.operators import sequence
from dealhouse.plans import catalog, marts, pipeline, states
from dealhouse.plans.warehouse import Warehouse
from dealhouse.session import scratch_dir

DEALS = ("acquirer_id string, announce_date date, transaction_id string, deal_type string, deal_year int, "
         "deal_size_mm double, ev_ebitda_multiple double, ev_revenue_multiple double, target_sector string")


def test_sources_are_landed_at_once(spark, monkeypatch):
    both = threading.Barrier(2, timeout=30)

    def write(self, layer, name, df):
        both.wait()  # one after the other would wait in vain
        return len(name)

    monkeypatch.setattr(Warehouse, "write", write)
    assert pipeline.land_raw(Warehouse(spark, scratch_dir(spark, "wh")), {"a": None, "bc": None}) == {"raw.a": 1, "raw.bc": 2}


def test_the_error_of_a_step_is_raised_when_all_have_ended(spark):
    from dealhouse.session import side_by_side

    ended = []

    def fails():
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        side_by_side(spark, [fails, lambda: ended.append(spark.range(3).count())])
    assert ended == [3]


def test_a_rollup_by_size_equals_the_one_by_days(spark):
    rows = [(a, d and dt.date(1996, 1, d), t, "T", 1996, s, 2.0, None, x) for a, d, t, s, x in (
        ("A", 2, "1", 1.5, "S"), ("A", 1, "2", 2.5, None), ("A", None, "3", None, "R"), ("A", 2, "1", 1.5, "S"), ("B", 1, "4", 1.0, "S"),
        (None, 1, "5", 1.0, "S"), (None, 1, None, 1.0, None))]
    deals = spark.createDataFrame(rows, DEALS)
    want = sorted(map(str, marts.activity_of(deals).collect()))
    for small in (1, 3, 100):
        assert sorted(map(str, marts.activity_by_size(deals, small).collect())) == want


def test_published_models_take_ordinary_groups_in_one_step(spark, monkeypatch):
    made = []
    for name in ("merge_activity", "write_timeline"):
        monkeypatch.setattr(pipeline, name, lambda wh, rows, *rest: made.append(rows))
    wh = Warehouse(spark, scratch_dir(spark, "wh"))
    deals = spark.range(3).select(*[F.lit(None).cast("string").alias(c) if c not in ("target_id", "acquirer_id") else F.lit("x").alias(c)
                                    for c in states.DEAL])
    types = {"announce_date": "date", "close_date": "date", "deal_year": "int", "deal_size_mm": "double",
             "ev_ebitda_multiple": "double", "ev_revenue_multiple": "double", "num_bidders": "int", "days_to_close": "int"}
    deals = deals.withColumns({c: F.col(c).cast(t) for c, t in types.items()})
    targets = spark.createDataFrame([("x", "X", "S")], "target_id string, target_name string, sector string")
    states._replace(wh, "deals", states._net(states.signed(deals, 1), states.DEAL), None, 0)
    counted = states.signed(deals, 1)
    states._replace(wh, "activity", states._net(states._of_activity(counted, targets), states.ACTIVITY), None, 0)
    states._replace(wh, "report", states._of_report(counted), None, 0)
    wh.write("analytics", "dim_target", targets)
    wh.write("analytics", "dim_acquirer", spark.createDataFrame([], "acquirer_id string, acquirer_name string, acquirer_type string"))
    states._publish_later(wh, range(states.BUCKETS), range(states.BUCKETS))
    one_window, sizes = sequence.sequence_parts, []
    monkeypatch.setattr(marts, "sequence_parts", lambda *a, small, **k: sizes.append(small) or one_window(*a, small=small, **k))
    states.publish(wh, dt.datetime(2025, 1, 1))
    assert sizes == [sequence.SMALL] and sorted(df.count() for df in made) == [1, 3]
    assert wh.noted(states.PENDING) == {}


def test_catalog_models_take_ordinary_groups_in_one_step(spark, monkeypatch):
    class Stop(Exception):
        pass

    asked = {}

    def timeline(*a):
        asked["timeline"] = a[3:]
        raise Stop

    monkeypatch.setattr(marts, "dim_acquirer_activity", lambda *a: asked.update(rollup=a[4:]))
    monkeypatch.setattr(marts, "fct_target_deal_sequence", timeline)
    monkeypatch.setattr(marts, "rpt_sector_trend_summary", lambda *a: None)
    monkeypatch.setattr(marts, "dimension_rows", lambda *a: None)

    class Store:
        create_namespaces = write = merge = read = lambda self, *a: None

    monkeypatch.setattr(catalog.stg, "transactions_quarantine", lambda raw: None)
    with pytest.raises(Stop):
        catalog.refresh(Store(), {}, dt.datetime(2025, 1, 1))
    assert asked == {"rollup": (sequence.SMALL,), "timeline": (sequence.SMALL,)}


def test_a_merge_into_a_catalog_table_makes_its_source_once(spark):
    store = catalog.CatalogStore(spark, scratch_dir(spark, "catalog"), "once_")
    store.create_namespaces()
    try:
        made = spark.sparkContext.accumulator(0)

        def counted(rows):
            for r in rows:
                made.add(1)
                yield r

        first = spark.createDataFrame([("a", "1", "h1")], "k string, v string, row_content_hash string")
        second = spark.createDataFrame(spark.createDataFrame([("a", "2", "h2"), ("b", "1", "h1")]).rdd.mapPartitions(counted), first.schema)
        columns = ["k", "v", "row_content_hash"]
        store.merge("analytics", "d", first, ["k"], columns)
        store.merge("analytics", "d", second, ["k"], columns)
        assert sorted(tuple(r) for r in store.read("analytics", "d").collect()) == [("a", "2", "h2"), ("b", "1", "h1")]
        assert made.value == 2
    finally:
        store.reset_layers()
