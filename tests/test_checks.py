import datetime as dt
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealhouse.operators.quality import ForeignKeyCheck, IntervalCheck, MatchCheck, RuleCheck, UniqueCheck, run_checks
from dealhouse.operators.rules import ALL_CHECKS, CODED, business_days_between


def verdicts(df):
    return {(r["check_name"], r["table_name"]): (r["violations"], r["passed"]) for r in df.collect()}


def test_generic_checks_pass_and_fail(spark):
    t = spark.createDataFrame([("a", "x", 1), ("a", "y", -1), (None, "q", None), (None, "z", 2)],
                              "id string, ref string, n int")
    r = spark.createDataFrame([("x",), ("y",)], "ref string")
    checks = [
        UniqueCheck("u", "t", ("id",)),                       # 'a' and the NULL group repeat
        ForeignKeyCheck("fk", "t", ("ref",), "r", ("ref",)),  # q, z orphaned
        RuleCheck("neg", "t", lambda: F.col("n") < 0),        # NULL is not a violation
        MatchCheck("m", "t", ("ref",), "r", ("ref",)),
        RuleCheck("ok", "t", lambda: F.col("n") > 100),
    ]
    got = verdicts(run_checks({"t": t, "r": r}, checks))
    assert got == {("u", "t"): (2, False), ("fk", "t"): (2, False), ("neg", "t"): (1, False),
                   ("m", "t"): (2, False), ("ok", "t"): (0, True)}


def test_fk_counts_null_keys_as_orphans_and_hot_keys_fully(spark):
    rows = [("hot",)] * 50 + [(None,)] * 3 + [("ok",)]
    t = spark.createDataFrame(rows, "k string")
    r = spark.createDataFrame([("ok",)], "k string")
    got = verdicts(run_checks({"t": t, "r": r}, [ForeignKeyCheck("fk", "t", ("k",), "r", ("k",))]))
    assert got[("fk", "t")] == (53, False)


def test_catalogue_names_unique_and_complete():
    names = ALL_CHECKS.names()
    assert len(names) == len(set(names)) and len(CODED.checks) == 13


def test_business_days_closed_form_matches_brute_force(spark):
    rng = random.Random(7)
    pairs = []
    for _ in range(400):
        a = dt.date(2000, 1, 1) + dt.timedelta(days=rng.randrange(4000))
        pairs.append((a, a + dt.timedelta(days=rng.randrange(-5, 60))))
    df = spark.createDataFrame(pairs, "a date, b date")
    got = [r[0] for r in df.select(business_days_between("a", "b")).collect()]

    def brute(a, b):
        if b < a:
            return None
        return sum(1 for i in range(1, (b - a).days + 1) if (a + dt.timedelta(days=i)).weekday() < 5)

    assert got == [brute(a, b) for a, b in pairs]


def test_coded_checks_on_driver_data(spark):
    from dealhouse.model import Model
    m = Model(spark, "/root/testdata/sf0.01")
    got = verdicts(run_checks(m.check_tables(), CODED.checks))
    assert got[("chk_transactions_unique", "transactions")][0] > 0
    assert got[("chk_transactions_fk_target", "transactions")][0] > 0
    assert got[("chk_nonneg_acquirers", "acquirers")][0] > 0
    assert got[("chk_nonneg_sector_multiples", "sector_multiples")] == (0, True)


def test_every_check_finds_its_violation(spark):
    """One small warehouse in which each check of the catalogue has something to find."""
    from dealhouse.model import Model

    m = Model(spark, "/root/testdata/sf0.001")
    d = dt.date
    rows = {
        "transactions": [
            dict(transaction_id="TXN-1", target_id="TGT-1", acquirer_id="ACQ-1", announce_date=d(2020, 1, 6),
                 close_date=d(2020, 1, 1), deal_year=2019, deal_quarter="Q3", deal_type="1-URGENT", financing_type="R",
                 deal_size_mm=-1.0, ev_ebitda_multiple=500.0, synergy_pct_of_deal=120.0, days_to_close=3),
            dict(transaction_id="TXN-1", target_id="nope", acquirer_id="nope", outcome=" closed "),
            dict(transaction_id="TXN-2", announce_date=d(2020, 1, 6), close_date=d(2020, 2, 6)),
            dict(transaction_id="TXN-3", announce_date=d(2020, 1, 6), close_date=d(2020, 2, 6), days_to_close=400)],
        "targets": [dict(target_id="TGT-1", sector="S", sub_sector="of another", employee_count=1, ltm_revenue_mm=900.0),
                    dict(target_id="TGT-1", employee_count=-1), dict(target_id="7")],
        "acquirers": [dict(acquirer_id="ACQ-1", acquirer_type="Financial Sponsor", headquarters="Nowhere",
                           ticker_or_status="Private"), dict(acquirer_id="ACQ-1", annual_revenue_mm=-1.0), dict(acquirer_id="B-1")],
        "acquirer_financials": [dict(acquirer_id="ACQ-1", fiscal_year=1900, market_cap_mm=1.0),
                                dict(acquirer_id="ACQ-1", fiscal_year=1900, revenue_mm=-1.0)],
        "sector_multiples": [dict(sector="S", fiscal_year=2020, fiscal_quarter="Q1", p25_ev_ebitda=3.0, median_ev_ebitda=2.0),
                             dict(sector="S", fiscal_year=2020, fiscal_quarter="Q1", deal_count=-1)],
    }
    tables = m.reference_tables()
    for name, given in rows.items():
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in m.staged(name).schema])
        tables[name] = spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in given], schema)
    got = verdicts(run_checks(tables, ALL_CHECKS.checks))
    assert {k for k, (n, passed) in got.items() if not n or passed} == set()
    assert len(got) == len(ALL_CHECKS.checks) == 32


def test_all_checks_read_a_table_once_and_meet_in_one_keyed_exchange(spark, tmp_path):
    t = spark.createDataFrame([(1, "x", 1), (1, "y", -1), (2, None, 0)], "id int, ref string, n int")
    r = spark.createDataFrame([("x", "1"), (None, "7")], "ref string, other string")
    t.write.parquet(f"{tmp_path}/t")
    r.write.parquet(f"{tmp_path}/r")
    tables = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in "tr"}
    checks = [UniqueCheck("u", "t", ("id",)), UniqueCheck("u2", "t", ("id", "ref")), RuleCheck("neg", "t", lambda: F.col("n") < 0),
              ForeignKeyCheck("fk", "t", ("ref",), "r", ("ref",)), MatchCheck("m", "t", ("id",), "r", ("other",)),
              ForeignKeyCheck("back", "r", ("ref",), "t", ("ref",), ref_filter=lambda: F.col("n") > 5)]
    df = run_checks(tables, checks)
    assert verdicts(df) == {("u", "t"): (1, False), ("u2", "t"): (0, True), ("neg", "t"): (1, False),
                            ("fk", "t"): (2, False), ("m", "t"): (2, False), ("back", "r"): (2, False)}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
    assert plan.count("Aggregate [check") == 2              # by (check, key), then by check
    empty = {n: d.limit(0) for n, d in tables.items()}
    assert set(verdicts(run_checks(empty, checks)).values()) == {(0, True)}


def test_interval_check_equals_brute_force(spark):
    rng = random.Random(3)
    rules = [("a", 0.0, 2.0), ("a", 5.0, 7.0), ("a", 6.0, 6.5), ("b", None, 1.0), ("c", 9.0, None), ("c", 9.0, None),
             (None, 0.0, 1.0), ("e", 3.0, 1.0)]
    # a hot key, exact ends, NULL keys and values, a key without rules, an interval that holds nothing
    rows = [(rng.choice("aaaaabcde"), rng.choice([0.0, 2.0, 5.0, 7.0, 9.0, rng.uniform(-1, 12)])) for _ in range(500)]
    rows += [(None, 3.0), ("a", None), ("a", 3.0), ("a", 3.0)]

    def broken(key, value):
        mine = [(lo, hi) for k, lo, hi in rules if k == key and k is not None]
        return value is not None and bool(mine) and not any(
            (lo is None or value >= lo) and (hi is None or value <= hi) for lo, hi in mine)

    t = spark.createDataFrame(rows, "kind string, x double").withColumn("lo", F.lit("clash"))
    text = [(k, None if lo is None else str(lo), None if hi is None else str(hi)) for k, lo, hi in rules]
    check = IntervalCheck("i", "t", "kind", "x", "r", "kind")
    for r in (spark.createDataFrame(rules, "kind string, lo double, hi double"),
              spark.createDataFrame(text, "kind string, lo string, hi string")):
        got = verdicts(run_checks({"t": t, "r": r}, [check, RuleCheck("n", "t", lambda: F.col("x").isNull())]))
        want = sum(broken(*row) for row in rows)
        assert 0 < want < len(rows) and got == {("i", "t"): (want, False), ("n", "t"): (1, False)}
    assert verdicts(run_checks({"t": t, "r": r.limit(0)}, [check])) == {("i", "t"): (0, True)}


def test_id_formats_of_each_table(spark):
    acquirers = spark.createDataFrame([("ACQ-1",), ("TGT-1",), ("ACQ-",), (None,)], "acquirer_id string")
    targets = spark.createDataFrame([("TGT-7",), (" TGT-7",)], "target_id string")
    checks = [ALL_CHECKS.get("chk_id_format_acquirers"), ALL_CHECKS.get("chk_id_format_targets")]
    assert [v for v, _ in sorted(verdicts(run_checks({"acquirers": acquirers, "targets": targets}, checks)).values())] == [1, 2]
