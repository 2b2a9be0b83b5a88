"""LZ phrase fingerprints against a whole-table walk in plain Python."""
from __future__ import annotations

import hashlib
import random

import numpy as np
import xxhash

from dealhouse.llm import lz_fingerprint as lz

MASK = (1 << 64) - 1


def phrases(text):
    """LZ78 by its definition: cut off the shortest prefix that is no phrase yet."""
    seen = []
    while text:
        n = next((n for n in range(1, len(text) + 1) if text[:n] not in seen), None)
        if n is None:
            break
        seen.append(text[:n])
        text = text[n:]
    return seen


def phrase_hash(phrase):
    h = sum((ord(c) + 1) * pow(lz.BASE, i, 1 << 64) for i, c in enumerate(phrase)) & MASK
    h = ((h ^ h >> 30) * 0xBF58476D1CE4E5B9) & MASK
    h = ((h ^ h >> 27) * 0x94D049BB133111EB) & MASK
    return h >> 32


def sketch(text):
    return sorted({phrase_hash(p) for p in phrases(text)})[:64]


def alike(a, b):
    least = sorted(set(a) | set(b))[:64]
    return len([h for h in least if h in a and h in b]) / len(least) if least else 1.0


def text_hash(text):
    h = xxhash.xxh64_intdigest((text or "").encode(), seed=42)
    return h - (1 << 64) if h >> 63 else h


def brute(rows):
    """All result rows, sorted."""
    order = sorted(rows, key=lambda r: text_hash(r[1]), reverse=True)
    order = sorted([r for r in order if r[0] is not None], key=lambda r: r[0], reverse=True) + \
        [r for r in order if r[0] is None]
    hexed = lambda hashes: "".join(f"{h:08x}" for h in hashes)
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, other, following = sketch(text), sketch(edited), sketch(after)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), hexed(own), hexed(other),
                    alike(own, other), alike(own, following)))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_equals_walk_over_ranges(make_docs):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("abcde é😀\n") for _ in range(rng.choice([0, 1, 2, 7, 300]))))
            for i in rng.sample(range(1000), 60)]
    rows += [(2000, None), (2001, ""), (2002, "x" * 30000)]
    for ranges in (1, 7, 200):
        assert result(lz.edited_neighbours(make_docs(rows), ranges=ranges)) == brute(rows)


def test_lone_row_and_empty_table(make_docs):
    rows = [(4, "one lonely text")]
    assert result(lz.edited_neighbours(make_docs(rows))) == brute(rows)
    assert lz.edited_neighbours(make_docs([])).count() == 0


def test_repeated_and_null_ids_follow_by_text_hash(make_docs):
    rows = [(1, "a b"), (1, "a b"), (1, "zz"), (None, "n"), (None, None), (None, ""), (3, "c")]
    assert result(lz.edited_neighbours(make_docs(rows), ranges=4)) == brute(rows)
    rows = [(None, "n"), (None, "m")]
    assert result(lz.edited_neighbours(make_docs(rows), ranges=4)) == brute(rows)


def test_a_hot_id_and_equal_rows_are_spread(make_docs):
    rng = random.Random(3)
    rows = [(i, f"text {i} " + rng.choice("xyz") * 5) for i in range(60)]
    rows += [(30, f"hot {i % 25}") for i in range(30)] + [(31, "same words")] * 30
    assert result(lz.edited_neighbours(make_docs(rows), ranges=9)) == brute(rows)


def test_ids_of_text(spark):
    rows = [("b", "one"), ("a", "two"), ("c", "three"), (None, "four")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    assert result(lz.edited_neighbours(docs, ranges=3)) == brute(rows)


def test_extra_columns_do_not_clash(make_docs):
    from pyspark.sql import functions as F
    docs = make_docs([(1, "abc"), (2, "abd")])
    for c in ("part", "hash", "row", "kind", "edge", "fingerprint", "from", "to", "next"):
        docs = docs.withColumn(c, F.lit("x"))
    assert result(lz.edited_neighbours(docs)) == brute([(1, "abc"), (2, "abd")])


def test_likeness_orders_edits():
    rng = random.Random(1)
    text = " ".join(rng.choice(["the", "ring", "stone", "wall", "river"]) + str(rng.randrange(50)) for _ in range(400))
    other = " ".join(rng.choice(["blu", "krä", "zwo"]) + str(rng.randrange(50, 99)) for _ in range(400))
    f = lz.fingerprint
    assert lz.likeness(f(text), f(text)) == 1
    assert lz.likeness(f(text), f(text[:-20] + other[:20])) > 0.6
    assert lz.likeness(f(text), f(other)) < 0.3
    assert lz.likeness(f(""), f("")) == 1 and lz.likeness(f(""), f("a")) == 0


def test_parse_goes_back_to_a_mark():
    text = "abababcabcabcdd" * 9
    parse = lz.Parse()
    head = parse.feed(text[:50])
    mark = parse.mark()
    for _ in range(2):
        ends = head + parse.feed(text[50:], 50)
        assert [text[a:b] for a, b in zip([0, *ends], ends)] == phrases(text)
        parse.back(mark)
        parse.feed("quite another end", 50)
        parse.back(mark)


def test_signature_holds_the_least_distinct_hashes():
    rng = np.random.default_rng(4)
    for n, top in ((10, 5), (300, 70), (5000, 1 << 32), (5000, 100)):
        hashes = rng.integers(0, top, n, dtype=np.uint32)
        assert lz.signature(hashes).tolist() == sorted(set(hashes.tolist()))[:64]
