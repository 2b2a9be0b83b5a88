"""Toxicity: the chain against the sum over all paths, and held-out accuracy."""
from __future__ import annotations

import itertools
import random
from binascii import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealhouse.llm import toxicity as tx

LABELS = "doc_id long, quality int, toxic int"


def paths(theta, sequence):
    """Weight of every path of states over a sequence of classes, one by one."""
    start, move, each = tx._steps(theta)
    weights = np.concatenate(([1.0], np.exp(theta[4:])))
    for states in itertools.product((0, 1), repeat=len(sequence)):
        total = 0.0
        for before in (0, 1):
            w, last = start[before], before
            for s, c in zip(states, sequence, strict=True):
                w *= move[last, s] * (weights[c] if s else 1.0)
                last = s
            total += w
        yield states, total


@pytest.mark.parametrize("sequence", [[0], [3], [0, 0, 1], [2, 0, 0, 5, 5, 0, 0], [0, 0, 0, 0, 7, 0, 0, 1, 0]])
def test_chain_equals_all_paths(sequence):
    rng = np.random.default_rng(len(sequence))
    theta = rng.normal(size=4 + tx.CLASSES)
    z = sum(w for _, w in paths(theta, sequence))
    hits = [(i, c) for i, c in enumerate(sequence) if c]
    rows = [(len(sequence), [i for i, _ in hits], [c for _, c in hits], 0)]
    assert tx.log_partition(theta, *tx._padded(rows)) == pytest.approx(np.log(z))
    want = [sum(w for s, w in paths(theta, sequence) if s[i]) / z for i, _ in hits]
    assert tx.marginals(theta, len(sequence), hits) == pytest.approx(want)


def test_label_counts():
    counts = tx.label_counts(6, [(1, 2), (2, 2), (4, 3)], 1)
    assert counts[1] == 2 and counts[2] == 2 and counts[3] == 1  # in twice, out twice, on once
    assert counts[3 + 2] == 2 and counts[3 + 3] == 1
    assert not tx.label_counts(6, [(1, 2)], 0).any()


@pytest.mark.parametrize("seed", range(4))
def test_expected_counts_equal_all_paths(seed):
    rng = np.random.default_rng(seed)
    theta = rng.normal(size=4 + tx.CLASSES)
    sequences = [[0], [0, 0, 0], [3], [2, 0, 0, 5, 5, 0, 0], [0, 0, 7, 1], []]
    rows = [(len(s), [i for i, c in enumerate(s) if c], [c for c in s if c], 0) for s in sequences]
    got = tx.expected_counts(theta, *tx._padded(rows))
    eps = 1e-5

    def log_z(t):
        return sum(np.log(sum(w for _, w in paths(t, s))) for s in sequences if s)

    want = [(log_z(theta + eps * e) - log_z(theta - eps * e)) / (2 * eps) for e in np.eye(len(theta))]
    start = np.exp(theta[0]) / (1 + np.exp(theta[0]))  # the empty text's own start
    want[0] += start
    assert got[0] == pytest.approx(log_z(theta) + np.log(1 + np.exp(theta[0])))
    assert got[1] == pytest.approx(want, abs=1e-6)


def test_the_fitted_chain_is_the_optimum(spark):
    """The ridge makes the loss strongly convex: a brute-force gradient g proves the optimum within |g| of the fit."""
    rng = random.Random(5)
    rows = []
    for _ in range(40):
        n = rng.randrange(1, 8)
        classes = [rng.choice([0, 0, 1, 3, 6, tx.CLASSES]) for _ in range(n)]
        hits = [(i, c) for i, c in enumerate(classes) if c]
        rows.append((n, [i for i, _ in hits], [c for _, c in hits], int(rng.random() < 0.5), classes))
    schema = "n int, at array<int>, classes array<int>, toxic int"
    theta = tx.fit_chain(spark.createDataFrame([r[:4] for r in rows], schema).repartition(3))
    observed = sum(tx.label_counts(n, list(zip(at, c)), t) for n, at, c, t, _ in rows)

    def loss(t):
        return sum(np.log(sum(w for _, w in paths(t, s))) for *_, s in rows) - observed @ t + t @ t / 2

    eps = 1e-4
    slope = np.array([(loss(theta + eps * e) - loss(theta - eps * e)) / (2 * eps) for e in np.eye(len(theta))])
    assert slope @ slope / 2 <= 1.1 * tx.GAP


def test_an_id_with_many_rows_does_not_widen_the_sample(spark):
    rows = [(1, f"text number {i} of one id") for i in range(200)] + [(1, "repeated text")] * 200 + [(3, "other"), (4, None)]
    labels = spark.createDataFrame([(1, 1, 1), (3, 1, 0), (4, 1, 0)], LABELS)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = tx.training_sample(docs, labels, train_rows=50).collect()
    assert len(got) == 50 and len({r["text"] for r in got}) == 50
    whole = tx.training_sample(docs, labels).collect()
    assert sorted((r["sample_id"], r["text"] or "") for r in whole) == sorted({(i, t or "") for i, t in rows if i != 2})


def test_documents_without_cues_score_alike(fitted, make_docs):
    _, model, _ = fitted
    docs = make_docs([(1, ""), (2, None), (3, "the river"), (4, "the old road " * 40_000)])
    assert len({r["score"] for r in tx.score_documents(docs, model).collect()}) == 1


def corpus(n=900):
    rng = random.Random(21)
    plain = ["the", "river", "stone", "wall", "green", "tree", "old", "road"] + [f"w{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(3, 80))]
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(1 + len(words) // 15):
                words.insert(rng.randrange(len(words) + 1), rng.choice(["Idiot!", "SCUM", "vileness", "vilest", "viles"]))
        docs.append((i, " ".join(words)))
        if rng.random() < 0.8:
            labels.append((i, 1, int(toxic)))
    return docs, labels, {i: t for i, _, t in labels}


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels, truth = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    return df, tx.fit(df, spark.createDataFrame(labels, LABELS)), truth


def test_held_out_accuracy(fitted):
    df, model, truth = fitted
    got = {r["doc_id"]: r for r in tx.score_documents(df, model).collect()}
    held = [i for i in truth if crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 100
    hit = [(got[i]["score"] >= tx.THRESHOLD) == bool(truth[i]) for i in held]
    assert sum(hit) / len(hit) > 0.97
    assert 0 <= min(r["score"] for r in got.values()) and max(r["score"] for r in got.values()) <= 1


def test_spans_are_the_offending_words(fitted, make_docs):
    _, model, _ = fitted
    text = "the old idiot! on a green road,\nvilest scum"
    docs = make_docs([(1, text), (2, None), (3, ""), (4, "the river"), (None, text), (1, text)])
    got = tx.score_documents(docs.withColumn("score", F.lit("clash")), model).collect()
    assert len(got) == 6
    for r in got:
        words = [text[s["start"]:s["end"]] for s in r["spans"]]
        assert words == (["idiot!", "vilest", "scum"] if r["doc_id"] in (1, None) else [])
    scores = {r["doc_id"]: r["score"] for r in got}
    assert scores[1] > tx.THRESHOLD > max(scores[2], scores[3], scores[4])


def test_drop_keeps_clean_rows_as_they_are(fitted, make_docs):
    _, model, _ = fitted
    docs = make_docs([(1, "idiot scum idiot"), (2, None), (3, "the river"), (3, "the river")]).withColumn("score", F.lit("x"))
    out = tx.drop_toxic(docs, model)
    assert out.schema == docs.schema
    assert sorted(r["doc_id"] for r in out.collect()) == [2, 3, 3]


def test_held_out_rows_teach_nothing(spark):
    docs, labels, _ = corpus(300)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    held = [x for x in labels if crc32(str(x[0]).encode()) % 4 == 2]
    model = tx.fit(df, spark.createDataFrame(held, LABELS))
    assert not model.cues and {r["score"] for r in tx.score_documents(df, model).collect()} == {0.0}


def test_bounded_sample_and_odd_labels(spark):
    docs, labels, _ = corpus(300)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    odd = labels + labels[:5] + [(None, 1, 1), (7, None, None), (10**9, 1, 1)]
    assert tx.training_sample(df, spark.createDataFrame(odd, LABELS), train_rows=50).count() <= 50


def test_empty_tables(spark, make_docs):
    empty = spark.createDataFrame([], LABELS)
    assert tx.score_documents(make_docs([]), tx.fit(make_docs([]), empty)).count() == 0
    assert tx.drop_toxic(make_docs([]), tx.ToxicityModel()).count() == 0


def test_only_exact_copies_leave_the_sample(spark):
    rng = random.Random(8)
    passage = "a passage that a third of all documents hold word by word "
    docs = [(i, passage + " ".join(f"u{rng.randrange(10**6)}" for _ in range(60))) for i in range(120)]
    docs += [(200 + i, "The  same text, twice!" if i % 2 else "the same text twice") for i in range(12)]
    labels = [(i, 1, 0) for i, _ in docs if crc32(str(i).encode()) % 4 != 2]
    got = tx.training_sample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, LABELS))
    ids = [r["sample_id"] for r in got.collect()]
    assert sorted(i for i in ids if i < 200) == sorted(i for i, _, _ in labels if i < 200)
    assert [i for i in ids if i >= 200] == [min(i for i, _, _ in labels if i >= 200)]


@pytest.mark.parametrize("sequence", [[0], [0, 0, 0, 0], [0, 0, 1], [2, 0, 0, 5, 5, 0, 0], [0, 0, 0, 0, 7, 0, 0, 1, 0]])
def test_tokens_without_cue_have_marginals(sequence):
    for seed in range(8):
        theta = np.random.default_rng(seed).normal(size=4 + tx.CLASSES) * 2
        weights = list(paths(theta, sequence))
        z = sum(w for _, w in weights)
        want = [sum(w for s, w in weights if s[i]) / z for i in range(len(sequence))]
        expected, sure = tx.tagged(theta, len(sequence), [(i, c) for i, c in enumerate(sequence) if c])
        assert expected == pytest.approx(sum(want))
        assert sure == pytest.approx({i: p for i, p in enumerate(want) if p >= 0.5})


def test_a_span_has_no_hole_where_the_context_is_toxic(make_docs):
    theta = np.zeros(4 + tx.CLASSES)
    theta[:4], theta[4:] = (-3.0, -3.0, -3.0, 2.0), 6.0
    model = tx.ToxicityModel({"=idiot": 5.0}, theta, (0.0, 1.0, 0.0, 0.0))
    text = "idiot unseen idiot and then a long way home on the road"
    got = tx.score_documents(make_docs([(1, text)]), model).first()
    assert [text[s["start"]:s["end"]] for s in got["spans"]][:3] == ["idiot", "unseen", "idiot"]
