"""Bands by sector and countries with their regions, on literal frames."""
from pyspark.sql import functions as F

from dealhouse.operators import bands, geography


def test_bands_exact_and_sketched(spark):
    rows = [("A", float(i), 10) for i in range(1, 101)] + [("A", 9000.0, 10), ("A", -9000.0, 10)]
    rows += [("B", 5.0, 1)] * 400 + [("B", 6.0, 1), ("B", None, 3), ("B", 7.0, 0), ("B", 7.0, None)] + [(None, 1.0, 1)]
    df = spark.createDataFrame(rows, "sector string, ltm_revenue_mm double, employee_count int")
    ratio = bands.per_head("ltm_revenue_mm", "employee_count")
    for accuracy in (None, 1000):
        got = {r["sector"]: tuple(r)[1:] for r in bands.sides_by_group(df, "sector", ratio, accuracy).collect()}
        assert got == {"A": (102, 1, 1), "B": (401, 0, 1), None: (1, 0, 0)}
    assert bands.with_band(df, "sector", ratio).count() == len(rows)
    assert bands.sides_by_group(df.limit(0), "sector", ratio).count() == 0


def test_sketch_ranks_hold_over_many_partitions(spark):
    df = spark.range(0, 200_000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("s"), F.col("id") % 11)).alias("sector"),
        (F.xxhash64("id") % 100_000).cast("double").alias("size"), F.lit(7).alias("heads"))
    got = bands.sketch_ranks(df, "sector", bands.per_head("size", "heads"), 100).collect()
    assert len(got) == 12 and all(r["within_error"] for r in got)
    assert sum(r["rows_with_ratio"] for r in got) == 200_000


def test_geography_verdicts(spark):
    tree = spark.createDataFrame([("India", "Kerala"), ("USA", "California"), ("USA", "Georgia"), ("Georgia", "Imereti"),
                                  ("Spain", "Granada"), ("Nicaragua", "Granada"), ("Monaco", None)],
                                 "country string, subdivision string")
    cases = {"California, India": "mismatch", "india/KERALA": "consistent", "USA": "partial", "Kerala": "partial",
             "Georgia; Imereti": "consistent", "Granada, Nicaragua": "consistent", "Granada, USA": "mismatch",
             "California, India, Atlantis": "mismatch", "Austin, California, USA": "unknown", "Nowhere": "unknown",
             " , / ": "missing", "": "missing", None: "missing", "USA, USA, California": "consistent"}
    rows = [(a,) for a in cases] + [("USA",)] * 50
    got = geography.address_verdicts(spark.createDataFrame(rows, "hq string"), "hq", tree).collect()
    assert {r["address"]: r["verdict"] for r in got} == cases
    assert {r["address"]: r["rows"] for r in got}["USA"] == 51
    assert geography.address_verdicts(spark.createDataFrame([], "hq string"), "hq", tree).count() == 0
