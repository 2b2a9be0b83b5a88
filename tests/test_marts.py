import datetime as dt

from dealhouse.model import RUN_TS
from dealhouse.plans import marts

TX = ("transaction_id string, target_id string, acquirer_id string, announce_date date, close_date date, "
      "deal_year int, deal_quarter string, deal_type string, financing_type string, deal_size_mm double, "
      "ev_ebitda_multiple double, ev_revenue_multiple double, synergy_pct_of_deal double, outcome string, "
      "strategic_rationale_tags string, num_bidders int, days_to_close int")
D = dt.date


def tx(spark, rows):
    base = dict.fromkeys([f.split()[0] for f in TX.split(", ")])
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], TX)


def dims(spark):
    tg = spark.createDataFrame([("T1", "n1", "S1"), ("T2", "n2", "S2")], "target_id string, target_name string, sector string")
    aq = spark.createDataFrame([("A1", "Acme", "Strategic")], "acquirer_id string, acquirer_name string, acquirer_type string")
    return tg, aq


def test_activity_rollup_semantics(spark):
    tg, aq = dims(spark)
    t = tx(spark, [
        dict(transaction_id="X2", target_id="T1", acquirer_id="A1", announce_date=D(2020, 1, 1), deal_year=2020,
             deal_type="LBO", deal_size_mm=10.0),
        dict(transaction_id="X1", target_id="T9", acquirer_id="A1", announce_date=D(2020, 1, 1), deal_year=2022,
             deal_type="Merger", deal_size_mm=None),
        dict(transaction_id="X3", target_id="T2", acquirer_id=None, deal_year=2021, deal_type="LBO"),
    ])
    out = {r["acquirer_id"]: r for r in marts.dim_acquirer_activity(t, tg, aq, RUN_TS).collect()}
    a1 = out["A1"]
    assert a1["deal_count"] == 2 and a1["total_deal_volume_mm"] == 10.0
    assert a1["deal_types_observed"] == "Merger | LBO"          # ordered by date, then id
    assert a1["sectors_touched"] == "Unknown | S1"
    assert a1["distinct_target_sectors"] == 1
    assert a1["avg_deals_per_active_year"] == 2 / 3
    assert out[None]["avg_deals_per_active_year"] is None and out[None]["acquirer_name"] is None


def test_sequence_lags_and_flags(spark):
    tg, _ = dims(spark)
    t = tx(spark, [
        dict(transaction_id="B", target_id="T1", acquirer_id="A1", announce_date=D(2020, 3, 1), deal_size_mm=5.0),
        dict(transaction_id="A", target_id="T1", acquirer_id="A1", announce_date=D(2020, 1, 1), deal_size_mm=2.0),
        dict(transaction_id="C", target_id="T1", acquirer_id=None, announce_date=None),
        dict(transaction_id="D", target_id=None, acquirer_id="A1"),
    ])
    rows = {r["transaction_id"]: r for r in marts.fct_target_deal_sequence(t, tg, RUN_TS.date()).collect()}
    assert set(rows) == {"A", "B", "C"}
    assert [rows[k]["deal_sequence_number"] for k in "ABC"] == [1, 2, 3]
    assert rows["A"]["same_acquirer_as_prior"] is False
    assert rows["B"]["same_acquirer_as_prior"] is True and rows["B"]["days_since_prior_announce"] == 60
    assert rows["B"]["deal_size_mm_delta_vs_prior"] == 3.0
    assert rows["C"]["same_acquirer_as_prior"] is None and rows["C"]["days_since_prior_announce"] is None


def test_report_drops_unknown_targets_and_counts_prefixes(spark):
    tg, _ = dims(spark)
    t = tx(spark, [
        dict(transaction_id="1", target_id="T1", deal_year=2020, outcome="closed", ev_ebitda_multiple=4.0),
        dict(transaction_id="2", target_id="T1", deal_year=2020, outcome="Pending review", ev_ebitda_multiple=None),
        dict(transaction_id="3", target_id="T9", deal_year=2020, outcome="Closed"),
    ])
    (r,) = marts.rpt_sector_trend_summary(t, tg, RUN_TS.date()).collect()
    assert (r["sector"], r["transaction_count"], r["closed_deal_count"], r["pending_deal_count"]) == ("S1", 2, 1, 1)
    assert r["avg_ev_ebitda_multiple"] == 4.0 and r["total_deal_size_mm"] is None


def test_sequence_equals_plain_window(spark):
    """Enough rows that range sampling would not see them all, a hot group, payload beside the keys."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from dealhouse.operators.sequence import sequence_with_prior

    n = 400_000
    i = F.col("id")
    df = spark.range(0, n, numPartitions=8).select(
        F.when(i % 3 != 0, "HOT").otherwise(F.concat(F.lit("T"), i % 37)).alias("g"),
        F.when(i % 11 != 0, F.xxhash64(i) % 700).alias("d"), F.xxhash64(i, F.lit(1)).alias("k"),
        (i % 7).alias("v"), F.concat(F.lit("payload-"), i).alias("payload"))
    cols = ["g", "d", "k", "v", "payload", "rn", "prior_k", "prior_v"]
    ours = sequence_with_prior(df, "g", ["d", "k"], ["k", "v"], "rn").select(cols)
    w = Window.partitionBy("g").orderBy(F.col("d").asc_nulls_last(), F.col("k").asc_nulls_last())
    plain = df.withColumns({"rn": F.row_number().over(w).cast("bigint"),
                            "prior_k": F.lag("k").over(w), "prior_v": F.lag("v").over(w)}).select(cols)
    both = ours.withColumn("side", F.lit(1)).unionByName(plain.withColumn("side", F.lit(-1)))
    assert both.groupBy(cols).agg(F.sum("side").alias("s"), F.count("*").alias("n")).filter("s <> 0 or n <> 2").count() == 0
    assert ours.count() == n


def test_activity_lists_and_sums_by_day_equal_direct(spark):
    import random

    from pyspark.sql import functions as F

    rng = random.Random(5)
    tg, _ = dims(spark)
    t = tx(spark, [dict(
        transaction_id=f"X{i:04d}", target_id=rng.choice(["T1", "T2", "T9", None]), acquirer_id="HOT" if i % 3 else f"A{i % 11}",
        announce_date=D(2020, 1, 1 + i % 9) if i % 13 else None, deal_year=2015 + i % 8, deal_size_mm=i / 7 if i % 5 else None,
        ev_ebitda_multiple=rng.choice([None, 4.25]), deal_type=rng.choice(["LBO", "Merger", None, ""])) for i in range(1500)])
    out = {r["acquirer_id"]: r for r in marts.activity_measures(t, tg).collect()}
    labelled = t.join(tg, "target_id", "left").withColumn("label", F.coalesce("sector", F.lit("Unknown")))
    by = "announce_date ASC NULLS LAST, transaction_id ASC NULLS LAST"
    direct = labelled.groupBy("acquirer_id").agg(
        F.expr(f"listagg(deal_type, ' | ') WITHIN GROUP (ORDER BY {by})").alias("types"),
        F.expr(f"listagg(label, ' | ') WITHIN GROUP (ORDER BY {by})").alias("labels"),
        F.countDistinct("sector").alias("sectors"), F.sum(F.col("deal_size_mm").cast("decimal(38,6)")).cast("double").alias("vol"))
    for r in direct.collect():
        got = out[r["acquirer_id"]]
        assert (got["deal_types_observed"], got["sectors_touched"]) == (r["types"], r["labels"])
        assert (got["distinct_target_sectors"], got["total_deal_volume_mm"]) == (r["sectors"], r["vol"])
    assert len(out) == direct.count() == 12


def test_sequence_of_one_group_and_one_key_is_spread(spark):
    """Every row has the same group and the same first key, or none: buckets of the second key share the work."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from dealhouse.operators.sequence import sequence_with_prior

    n = 400_000
    i = F.col("id")
    df = spark.range(0, n, numPartitions=8).select(
        F.lit("T1").alias("g"), F.when(i % 2 == 0, F.lit("2020-01-01").cast("date")).alias("d"),
        F.when(i % 1000 != 0, F.concat(F.lit("TXN-"), F.lpad(F.xxhash64(i).bitwiseAND(0xFFFFF).cast("string"), 8, "0"))).alias("k"),
        i.alias("tie"), F.when(i % 5 != 0, i % 7).alias("v"))
    cols = ["g", "d", "k", "tie", "v", "rn", "prior_k", "prior_v"]
    w = Window.partitionBy("g").orderBy(*[F.col(c).asc_nulls_last() for c in ("d", "k", "tie")])
    plain = df.withColumns({"rn": F.row_number().over(w).cast("bigint"),
                            "prior_k": F.lag("k").over(w), "prior_v": F.lag("v").over(w)}).select(cols)
    for prefix in (3, 10):
        ours = sequence_with_prior(df, "g", ["d", "k", "tie"], ["k", "v"], "rn", prefix=prefix).select(cols)
        both = ours.withColumn("side", F.lit(1)).unionByName(plain.withColumn("side", F.lit(-1)))
        assert both.groupBy(cols).agg(F.sum("side").alias("s"), F.count("*").alias("n")).filter("s <> 0 or n <> 2").count() == 0
    largest = df.groupBy("g", "d", F.substring("k", 1, 10)).count().agg(F.max("count")).first()[0]
    assert largest < n / 50
