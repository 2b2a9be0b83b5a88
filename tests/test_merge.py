import datetime as dt

import pytest
from pyspark.sql import functions as F

from dealhouse.operators.merge import DuplicateKeyError, ensure_column, scd1_merge
from dealhouse.plans.warehouse import ReadOnlyWarehouse, Warehouse

COLS = ["k", "v", "row_content_hash", "data_date"]
SCHEMA = "k string, v string, row_content_hash string, data_date date"
D1, D2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_scd1_updates_changed_inserts_new_keeps_vanished(spark):
    cur = frame(spark, [("a", "x", "h1", D1), ("b", "y", "h2", D1), ("gone", "z", "h3", D1), (None, "n", "h4", D1)])
    src = frame(spark, [("a", "x", "h1", D2), ("b", "y2", "h2b", D2), ("new", "w", "h5", D2), (None, "n", "h4", D2)])
    out = {r["k"]: r for r in scd1_merge(cur, src, ["k"], COLS).collect()}
    assert out["a"]["data_date"] == D1              # unchanged hash: row and stamp kept
    assert out["b"]["v"] == "y2" and out["b"]["data_date"] == D2
    assert out["new"]["data_date"] == D2
    assert out["gone"]["v"] == "z"                  # never deleted
    assert out[None]["data_date"] == D1             # NULL key matched null-safely
    assert len(out) == 5


def test_scd1_rerun_is_idempotent(spark):
    cur = frame(spark, [("a", "x", "h1", D1), (None, "n", "h4", D1)])
    once = scd1_merge(cur, cur, ["k"], COLS)
    twice = scd1_merge(once, cur, ["k"], COLS)
    assert sorted(map(tuple, twice.collect()), key=str) == sorted(map(tuple, cur.collect()), key=str)


def test_scd1_without_hash_updates_unconditionally(spark):
    cur = spark.createDataFrame([("a", 1, "x")], "k string, y int, v string")
    src = spark.createDataFrame([("a", 1, "y"), ("a", 2, "z")], "k string, y int, v string")
    out = {(r["k"], r["y"]): r["v"] for r in scd1_merge(cur, src, ["k", "y"], ["k", "y", "v"], None).collect()}
    assert out == {("a", 1): "y", ("a", 2): "z"}


def test_scd1_rejects_duplicate_source_keys(spark):
    src = frame(spark, [("a", "x", "h", D1), ("a", "y", "g", D1)])
    with pytest.raises(DuplicateKeyError):
        scd1_merge(frame(spark, [("b", "x", "h", D1)]), src, ["k"], COLS)
    assert scd1_merge(None, src, ["k"], COLS).count() == 2  # a first load keeps them for the checks to report


def test_scd1_adds_missing_columns(spark):
    old = spark.createDataFrame([("a", "x", "h1")], "k string, v string, row_content_hash string")
    src = frame(spark, [("b", "y", "h2", D2)])
    out = {r["k"]: r["data_date"] for r in scd1_merge(old, src, ["k"], COLS).collect()}
    assert out == {"a": None, "b": D2}
    assert ensure_column(old, "data_date", "date").schema["data_date"].dataType.typeName() == "date"


def test_partition_replace_static_semantics(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    rows = [(y, i) for y in (2001, 2002, 2003) for i in range(3)]
    df = spark.createDataFrame(rows, "deal_year int, i int")
    assert wh.replace_partitions("analytics", "f", df, "deal_year", [2001, 2002, 2003]) == {
        2001: 3, 2002: 3, 2003: 3}
    # replace 2002 with one row, clear 2003 (no rows), ignore 2001 rows not requested
    new = spark.createDataFrame([(2002, 9), (2001, 7)], "deal_year int, i int")
    assert wh.replace_partitions("analytics", "f", new, "deal_year", [2002, 2003]) == {2002: 1, 2003: 0}
    # rerun is idempotent
    wh.replace_partitions("analytics", "f", new, "deal_year", [2002, 2003])
    back = wh.read("analytics", "f")
    got = sorted((r["deal_year"], r["i"]) for r in back.collect())
    assert got == [(2001, 0), (2001, 1), (2001, 2), (2002, 9)]


def test_versioned_tables_and_read_only(spark, tmp_root):
    wh = Warehouse(spark, tmp_root, keep=2, retain_s=0)
    for i in range(3):
        assert wh.write("staging", "t", spark.range(i + 1).withColumn("v", F.lit(i))) == i + 1
    assert wh.versions("staging", "t") == [2, 3]
    assert wh.read("staging", "t").count() == 3
    slow_reader = Warehouse(spark, f"{tmp_root}/young", keep=1)
    for i in range(3):
        slow_reader.write("staging", "t", spark.range(i + 1))
    assert slow_reader.versions("staging", "t") == [1, 2, 3]  # too young to go
    ro = Warehouse(spark, tmp_root, read_only=True)
    with pytest.raises(ReadOnlyWarehouse):
        ro.write("staging", "t", spark.range(1))
    assert wh.reset_layers() == ["staging"]
    assert not wh.exists("staging", "t")


def test_row_counts_recorded_without_a_job(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    wh.write("staging", "t", spark.range(7))
    assert wh.row_count("staging", "t") == 7 and wh.row_count("staging", "missing") is None
