"""Personal data: base spans against the plain patterns, and what the classifier adds."""
from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from dealhouse.llm import pii


def brute(text):
    """The contract's patterns as they stand."""
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        odd = sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])
        if 16 <= len(d) <= 19 and odd % 10 == 0:
            out.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    pieces = ["a.b", "@", "x-1.com", ".", "1", "25", "255", "256", "+", "4111 1111 1111 1111", "4111-1111 11111111",
              " ", "-", "(0)", "é", "😀", "\n", "+49 30 1234567", "00", "10.0.0.1", "1.2.3", "0001.2.3.4", "%"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))
        assert sorted(pii.base_spans(text)) == sorted(brute(text)), text


def test_long_runs_are_linear():
    for text in ("1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "a@" * 100_000, "+1 " * 60_000, "+" + "1 " * 90_000):
        pii.candidates(text)


TEXTS = [
    (1, "mail bob@example.com or +1 (202) 555-0143, host 10.1.2.3, card 4111 1111 1111 1111."),
    (2, None), (3, ""), (4, "nothing here, version 4.0 of 1999"),
    (5, "phone (202) 555-0143 please"), (6, "contact jane [at] example [dot] com today")]


def test_query_columns(make_docs):
    docs = make_docs(TEXTS + [(7, "é😀 a@b.co"), (7, "é😀 a@b.co")]).withColumn("found", F.lit("clash"))
    found = pii.find_candidates(docs)
    got = pii.report(found, pii.fit(found)).collect()
    assert len(got) == 8
    for r in got:
        text = dict(TEXTS + [(7, "é😀 a@b.co")])[r["doc_id"]] or ""
        base = sorted(brute(text))
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(b[0] == k for b in base) for k in range(4)]
        assert r["base_sha256"] == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert set(pii.joined(base).split(",")) - {""} <= set(r["spans"].split(","))


def corpus():
    """Spelled-out addresses and national numbers amid order numbers that fail every check."""
    rng = random.Random(4)
    rows = []
    for i in range(400):
        d = [rng.randrange(10) for _ in range(15)]
        rows.append((i, rng.choice([
            f"please call {rng.randrange(200, 999)}-{rng.randrange(200, 999)}-{rng.randrange(1000, 9999)} now",
            f"mail to joe{i}@example.com or ann{i} [at] mail.com",
            f"order x{''.join(map(str, d))}y shipped",
            f"tel +1 (212) 555-{rng.randrange(1000, 9999)}",
            f"version {rng.randrange(9)}.{rng.randrange(99)} token k{rng.randrange(10**8, 10**9)}z"])))
    return rows


def test_classifier_adds_likely_spans_only(make_docs):
    rows = corpus()
    found = pii.find_candidates(make_docs(rows))
    model = pii.fit(found)
    got = {r["doc_id"]: r["spans"] for r in pii.report(found, model).collect()}
    for i, text in rows:
        if text.startswith(("order", "version")):
            assert got[i] == "", (text, got[i])
        if text.startswith("mail"):
            assert got[i].count("email") == 2, (text, got[i])
    assert (np_all(model.reliability))


def np_all(reliability):
    """Every labeler has proper distributions over its votes."""
    return abs(reliability.sum(axis=3) - 1).max() < 1e-9


def test_redact_keeps_columns_and_leaves_clean_texts(make_docs):
    docs = make_docs(TEXTS).withColumn("found", F.lit("clash"))
    model = pii.fit(pii.find_candidates(docs))
    out = pii.redact(docs, model)
    assert out.schema == docs.schema
    new = {r["doc_id"]: r for r in out.collect()}
    assert new[1]["text"] == "mail [EMAIL] or [PHONE], host [IP], card [CARD]."
    assert new[1]["n_chars"] == len(new[1]["text"])
    assert new[2]["text"] is None and new[3]["text"] == "" and new[4]["text"] == TEXTS[3][1]
    again = {r["doc_id"]: r["text"] for r in pii.redact(out, model).collect()}
    assert again == {i: r["text"] for i, r in new.items()}


def test_empty_table(make_docs):
    found = pii.find_candidates(make_docs([]))
    assert pii.report(found, pii.fit(found)).count() == 0
    assert pii.redact(make_docs([]), pii.SpanModel()).count() == 0


CARDS = "7536784127813050 4845168114407329"


def learned(rows):
    """The model of ``rows``, fitted without Spark."""
    counts = Counter((c[0], c[4]) for _, text in rows for c in pii.candidates(text))
    return pii.fit_patterns([(k, p, n) for (k, p), n in counts.items()])


def with_cards():
    """``corpus()``, and cards, international numbers and 16-digit order numbers that fail Luhn."""
    rng = random.Random(5)
    rows = corpus()
    for i in range(400, 700):
        d = "".join(rng.choice("0123456789") for _ in range(15))
        last = next(x for x in range(10) if pii.luhn(d + str(x)))
        rows.append((i, rng.choice([f"paid with {d}{last} today", f"number {d}{(last + 3) % 10} shipped",
                                    f"call +1 (212) 555-{rng.randrange(1000, 9999)} now"])))
    return rows


def test_neighbouring_numbers_are_candidates_of_their_own():
    for text, want in [(f"two {CARDS} here", [CARDS[:16], CARDS[17:]]),
                       ("2353820953013749 4550997810720808", ["4550997810720808"]),
                       ("4111 1111 1111 1111 2024", ["4111 1111 1111 1111"]),
                       ("call 212-555-0143 2024 or", ["212-555-0143"]),
                       ("+1 (202) 555-0143 1999 2024", ["+1 (202) 555-0143"]),
                       ("2125550143 2125550199 2125550123", ["2125550143", "2125550199", "2125550123"])]:
        got = [text[s:e] for _, s, e, _, _ in pii.candidates(text)]
        assert set(want) <= set(got), (text, got)
        assert all(sum(c.isdigit() for c in g) <= 19 for g in got)


def test_cards_side_by_side_are_masked():
    model = learned(with_cards())
    for text, want in [(f"two {CARDS} here", "two [CARD] [CARD] here"),
                       ("a 2353820953013749 4550997810720808 b", "a 2353820953013749 [CARD] b"),
                       ("a 4111 1111 1111 1111 / 7 b", "a [CARD] / 7 b"),
                       ("a +1 (202) 555-0143 199 2024 b", None)]:
        got = pii.mask(text, pii.decide(pii.candidates(text), model))
        assert got == want if want else "555-0143" not in got, got


def test_accepted_candidates_stay_covered():
    rng = random.Random(6)
    model = learned(with_cards())
    for _ in range(300):
        text = "".join(rng.choice([CARDS[:16], "4111 1111 1111 1111", "212-555-0143", "+1 (202) 555-0143", "2024", "x", "a@b.co"])
                       + rng.choice([" ", " ", "-", ", "]) for _ in range(rng.randrange(1, 8)))
        found = pii.candidates(text)
        spans = pii.decide(found, model)
        got = {i for _, s, e in spans for i in range(s, e)}
        assert got == {i for k, s, e, base, p in found if base or model.accepts(k, p) for i in range(s, e)}, text
        assert len(spans) == len(set(spans))
        starts = {(k, s, e) for k, s, e, base, _ in found if not base}
        taken = [(s, e) for _, s, e in pii.base_spans(text)]
        assert all(e <= a or s >= b for _, s, e in starts for a, b in taken), text


def test_classifier_weighs_patterns_by_all_their_rows():
    """The weights solve the regression on the corpus counts, however common a pattern is."""
    counts = Counter((c[0], c[4]) for _, text in with_cards() for c in pii.candidates(text))
    for times in (1, 1000, 10**6):
        kinds, patterns, rows = (np.array(x) for x in zip(*sorted((k, p, n * times) for (k, p), n in counts.items()), strict=True))
        model = pii.fit_patterns(list(zip(kinds.tolist(), patterns.tolist(), rows.tolist(), strict=True)))
        posterior, _ = pii.expectation_maximisation(kinds, patterns, rows.astype(float))
        x = pii._features(kinds, patterns)
        p = 1 / (1 + np.exp(-np.clip(x @ model.weights, -500, 500)))
        slope = x.T @ (rows * (p - posterior)) + model.weights
        assert np.abs(slope).max() < 1e-4 * rows.sum(), times


def test_a_spelled_out_address_is_found_whole():
    for n in (1, 63, 64, 65, 80, 5000):
        text = "é" + "x" * n + " [at] example [dot] com!"
        assert (0, 1, len(text) - 1) in list(pii.loose_spans(text))
    assert not [s for s in pii.loose_spans(" [at] example [dot] com") if s[0] == 0]
