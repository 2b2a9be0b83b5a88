"""Layers as catalog tables: made, replaced, evolved, dropped, and queried by name."""
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealhouse.plans.catalog import CatalogStore
from dealhouse.session import scratch_dir


@pytest.fixture()
def store(spark):
    s = CatalogStore(spark, scratch_dir(spark, "catalog"), f"t{uuid.uuid4().hex[:8]}_")
    s.create_namespaces()
    s.create_namespaces()  # again: nothing
    yield s
    s.reset_layers()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_full_refresh_matches_columns_by_name(spark, store):
    assert not store.exists("staging", "t")
    store.write("staging", "t", spark.createDataFrame([(1, "a")], "n int, v string"))
    store.write("staging", "t", spark.createDataFrame([("b", 2), ("c", 3)], "v string, n int"))
    assert store.exists("staging", "t") and rows(store.read("staging", "t")) == [(2, "b"), (3, "c")]
    store.write("staging", "t", store.spark.createDataFrame([], "n int, v string"))
    assert rows(store.read("staging", "t")) == []


def test_columns_are_added_once(spark, store):
    store.write("analytics", "t", spark.createDataFrame([(1,)], "n int"))
    for _ in range(2):
        store.ensure_column("analytics", "t", "data_date", T.DateType())
    assert rows(store.read("analytics", "t")) == [(1, None)]


def test_partitions_are_replaced_and_cleared(spark, store):
    def frame(*r):
        return spark.createDataFrame(list(r), "deal_year int, v string")

    store.replace_partitions("analytics", "f", frame((2001, "a"), (2002, "a"), (2003, "a"), (1800, "no")), "deal_year", [2001, 2002, 2003])
    store.replace_partitions("analytics", "f", frame((2002, "b"), (2001, "not asked for")), "deal_year", [2002, 2003])
    assert sorted((r["deal_year"], r["v"]) for r in store.read("analytics", "f").collect()) == [(2001, "a"), (2002, "b")]


def test_merge_and_reset(spark, store):
    def dim(*r):
        return spark.createDataFrame(list(r), "k string, v string, row_content_hash string")

    columns = ["k", "v", "row_content_hash"]
    store.merge("analytics", "d", dim(("a", "1", "h1"), (None, "n", "h0")), ["k"], columns)
    store.merge("analytics", "d", dim(("a", "2", "h2"), ("b", "1", "h1"), (None, "n", "h0")), ["k"], columns)
    got = spark.sql(f"SELECT k, v FROM {store.name('analytics', 'd')} WHERE k IS NOT NULL ORDER BY k").collect()
    assert [tuple(r) for r in got] == [("a", "2"), ("b", "1")] and store.read("analytics", "d").filter(F.isnull("k")).count() == 1
    store.reset_layers()
    assert not store.exists("analytics", "d")
