import datetime as dt
import math

from pyspark.sql import functions as F

from dealhouse.functions import (
    clean_str,
    content_hash,
    date_or_null,
    deal_size_tier,
    double_or_null,
    int_or_null,
    pct_vs_benchmark,
)


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_clean_str_strips_unicode_spaces_not_tabs(spark):
    got = one_col(spark, ["  a ", "\u00a0b\u00a0", "\tc\t", "\u3000d\u2009", None], clean_str)
    assert got == ["a", "b", "\tc\t", "d", None]


def test_int_or_null_rounds_half_away_from_zero(spark):
    got = one_col(spark, ["3.7", "2.5", "-3.5", "1e3", "x", "1_000", " 12 ", None, "99999999999", "NaN"],
                  int_or_null)
    assert got == [4, 3, -4, 1000, None, None, 12, None, None, None]


def test_double_or_null_rejects_java_suffixes(spark):
    got = one_col(spark, ["1d", "1f", "12.5", "n/a", "-0.5", ".5", "NaN", "Infinity"], double_or_null)
    assert got[:6] == [None, None, 12.5, None, -0.5, 0.5]
    assert math.isnan(got[6]) and got[7] == math.inf


def test_date_or_null_needs_full_date(spark):
    got = one_col(spark, ["2020", "2020-05", "2020/05/06", "1990-6-1", "2020-02-30", " 2021-01-02 "],
                  date_or_null)
    assert got == [None, None, dt.date(2020, 5, 6), dt.date(1990, 6, 1), None, dt.date(2021, 1, 2)]


def test_content_hash_canonical_doubles_and_nulls(spark):
    import hashlib
    df = spark.createDataFrame([("a", 1e7, None, dt.date(2020, 1, 2))], "s string, d double, i int, t date")
    got = df.select(content_hash(df, ["s", "d", "i", "t"])).first()[0]
    assert got == hashlib.md5(b"a||10000000.000000||||2020-01-02").hexdigest()


def test_deal_size_tier_bounds(spark):
    got = one_col(spark, [None, 99.9, 100.0, 499.99, 500.0, 1999.0, 2000.0], deal_size_tier, "double")
    assert got == [None, "Small", "Mid-Market", "Mid-Market", "Large", "Large", "Mega"]


def test_pct_vs_benchmark_guards(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 0.0), (2.0, 1e-10), (None, 1.0), (1.0, None)],
                               "v double, m double")
    got = [r[0] for r in df.select(pct_vs_benchmark("v", "m")).collect()]
    assert got == [100.0, None, None, None, None]
