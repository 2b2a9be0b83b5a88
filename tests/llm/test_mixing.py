"""Mixing: targets met or told, optimality, classifier accuracy, and realised copies."""
from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealhouse.llm import mixing as mx


def members_of(spark, p, t):
    return spark.createDataFrame([(i, int(x), [float(v) for v in m]) for i, (x, m) in enumerate(zip(t, p, strict=True))],
                                 "doc_id long, tokens long, member array<double>").repartition(4)


def soft_corpus(spread, seed=3):
    rng = np.random.default_rng(seed)
    return rng.dirichlet([spread] * 3, size=500), rng.integers(0, 900, size=500)


@pytest.mark.parametrize("at_least", [0.0, 1.0])
@pytest.mark.parametrize("spread", [0.2, 1.0, 3.0])
@pytest.mark.parametrize("weights", [[0.6, 0.3, 0.1], [0.2, 0.3, 0.5]])
def test_reachable_targets_are_met(spark, spread, at_least, weights):
    p, t = soft_corpus(spread)
    members = members_of(spark, p, t)
    rates = mx.fit_rates(members, weights, at_least)
    assert rates.reached and max(map(abs, rates.gaps)) <= mx.TOLERANCE
    got = dict(members.select("doc_id", rates.of(F.col("member"))).collect())
    rate = np.array([got[i] for i in range(500)])
    assert rate.min() >= at_least
    expected = (t * rate) @ p
    total = t.sum() if at_least < 1 else expected.sum()
    assert np.allclose(expected, np.array(weights) * total, rtol=0.01)
    assert np.allclose(expected, rates.expected)


def test_rates_are_the_least_changed_ones(spark):
    """No other rates meet the targets with less change: the multipliers of the bounds have the right sign."""
    p, t = soft_corpus(1.0)
    rates = mx.fit_rates(members_of(spark, p, t), [0.6, 0.3, 0.1], 0.0)
    rate = np.maximum(0.0, rates.base - p @ np.array(rates.pull))
    kept, out = rate > 0, rate == 0
    assert kept.any() and out.any()
    pull = np.linalg.lstsq(p[kept], 1 - rate[kept], rcond=None)[0]
    assert np.allclose(p[kept] @ pull, 1 - rate[kept], atol=1e-6)  # one multiplier per domain explains all changes
    assert (1 - p[out] @ pull <= 1e-6).all()                       # and would take the others below the bound


@pytest.mark.parametrize("at_least", [0.0, 1.0])
def test_targets_out_of_reach_are_told(spark, caplog, at_least):
    """No document belongs to the first domain by half, so no rates give it nine tenths."""
    rng = np.random.default_rng(5)
    p = rng.dirichlet([3.0, 3.0, 3.0], size=300)
    p = p[p[:, 0] < 0.5]
    rates = mx.fit_rates(members_of(spark, p, rng.integers(1, 900, size=len(p))), [0.9, 0.05, 0.05], at_least)
    assert not rates.reached and min(rates.gaps) < -0.1 and "out of reach" in caplog.text
    rate = np.maximum(at_least, rates.base - p @ np.array(rates.pull))
    assert rate.max() < 100


def test_a_domain_without_tokens_has_no_target(spark):
    p = np.array([[0.0, 0.8, 0.2], [0.0, 0.1, 0.9], [1.0, 0.0, 0.0]])
    rates = mx.fit_rates(members_of(spark, p, [100, 200, 0]), [0.5, 0.25, 0.25])
    assert rates.reached and rates.targets == pytest.approx((0.0, 150.0, 150.0))


def corpus():
    rng = random.Random(3)
    words = {"en": "the of and river stone".split(), "de": "der die und fluss stein".split(), "fr": "le la et pierre eau".split()}
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(rng.randrange(5, 60))), k, "s")
            for i, k in enumerate(rng.choices(["en", "de", "fr"], [0.7, 0.2, 0.1], k=400))]
    return rows + [(900, None, "en", "s"), (901, "", None, "s"), (902, "unheard", None, "s"), (None, "der die", "de", "s"),
                   (0, rows[0][1], rows[0][2], "s")]


def test_documents(make_docs):
    rows = corpus()
    docs = make_docs(rows).withColumn("member", F.lit("clash")).withColumn("words", F.lit("clash"))
    out = mx.mix_documents(docs, weights={"en": 0.4, "de": 0.4, "fr": 0.2}).collect()
    assert len(out) == len(rows)
    truth = {r[0]: r[2] for r in rows}
    assert all(r["domain"] == truth[r["doc_id"]] for r in out if r["doc_id"] is not None and r["doc_id"] < 400)
    tokens = {d: sum(r["rate"] * r["n_tokens"] for r in out if r["domain"] == d) for d in ("en", "de", "fr")}
    total = sum(tokens.values())
    assert tokens["en"] / total == pytest.approx(0.4, abs=0.02) and tokens["fr"] / total == pytest.approx(0.2, abs=0.02)
    assert all(abs(r["copies"] - r["rate"]) < 1 for r in out)
    assert all(sum(r["member"]) == pytest.approx(1) for r in out)


def test_applied_mix_keeps_columns_and_leaves_nothing_out(make_docs):
    docs = make_docs(corpus()).withColumn("row", F.lit("clash")).withColumn("use", F.lit("clash"))
    weights = {"en": 0.4, "de": 0.4, "fr": 0.2}
    mix, _ = mx.fit(docs, "lang", weights, at_least=1.0)
    out = mx.apply_mix(docs, mix)
    assert out.schema == docs.schema
    ids = [r["doc_id"] for r in out.collect()]
    assert set(ids) == {r[0] for r in corpus()} and len(ids) > len(corpus())


def test_no_labels_and_empty_table(make_docs):
    got = mx.mix_documents(make_docs([(1, "a b", None), (2, None, None)])).collect()
    assert [(r["domain"], r["rate"], r["copies"]) for r in got] == [(None, 1.0, 1)] * 2
    assert mx.mix_documents(make_docs([])).count() == 0
    one = mx.mix_documents(make_docs([(1, "a b", "en"), (2, "c", "en")])).collect()
    assert all(r["domain"] == "en" and r["rate"] == pytest.approx(1) for r in one)


def test_no_python_on_the_executors(make_docs):
    plan = mx.mix_documents(make_docs(corpus()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
