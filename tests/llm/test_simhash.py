"""SimHash groups against all pairs in plain Python."""
from __future__ import annotations

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from dealhouse.llm import simhash as sh


def groups(fps, max_bits=2):
    """fps: (doc_id, fp). Smallest id reachable, by all pairs."""
    parent = {i: i for i, _ in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in combinations(fps, 2):
        if (x ^ y).bit_count() <= max_bits:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {i: find(i) for i, _ in fps}


def brute_simhash(text, k=3):
    import xxhash
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def test_simhash_equals_bit_count():
    rng = random.Random(3)
    for n in (0, 1, 2, 3, 4, 50, 400):
        text = " ".join(rng.choice(["A", "bé", "c\t", "ÄÖ", "d\n\n"]) for _ in range(n))
        assert sh.simhash(text) == brute_simhash(text)
    assert sh.simhash(None) == 0


def test_simhash_of_blocks(monkeypatch):
    text = " ".join(str(i * i) for i in range(500))
    monkeypatch.setattr(sh, "BLOCK", 7)
    assert sh.simhash(text) == brute_simhash(text)


@pytest.mark.parametrize("max_posting", [1, 3, 64])
def test_links_equal_all_pairs(spark, max_posting):
    """Dense clouds around a few centres, so that postings are long and get refined."""
    rng = random.Random(11)
    fps = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(60):
            fp = centre
            for bit in rng.sample(range(64), rng.randrange(5)):
                fp ^= 1 << bit
            fps.add(fp)
    low = rng.getrandbits(56) << 8
    fps |= {low | x for x in range(0, 256, 3)}
    signed = [(fp - (1 << 64) if fp >> 63 else fp,) for fp in fps]
    got = {tuple(r) for r in sh.link_fingerprints(
        spark.createDataFrame(signed, "fp long"), max_posting=max_posting).collect()}
    want = {(a, b) for (a,), (b,) in combinations(sorted(signed), 2)
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    assert got == want


def corpus():
    rng = random.Random(7)
    words = ["w%d" % i for i in range(300)]
    rows, i = [], 0
    for _ in range(12):
        base = [rng.choice(words) for _ in range(400)]
        for _ in range(4):
            text = list(base)
            text[rng.randrange(len(text))] = "edit"
            rows.append((i, " ".join(text)))
            i += 1
    rows += [(i, rows[0][1]), (i + 1, rows[0][1].upper()), (i + 2, None), (i + 3, ""), (i + 4, " \n"), (i + 5, "lone")]
    return rows


def test_groups_equal_brute_force(make_docs):
    rows = corpus()
    want = groups([(i, brute_simhash(t)) for i, t in rows])
    got = sh.near_duplicates(make_docs(rows)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert len(set(want.values())) < len(rows) - 8


def test_empty_null_and_repeated_rows(make_docs):
    assert sh.near_duplicates(make_docs([])).count() == 0
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "z y x w")]
    got = sorted(((r["doc_id"] or -1), (r["component_id"] or -1)) for r in sh.near_duplicates(make_docs(rows)).collect())
    assert got == [(-1, -1), (-1, 5), (5, 5), (5, 5)]


def test_one_per_group_keeps_the_smallest(make_docs):
    rows = corpus()
    want = {i for i, root in groups([(i, brute_simhash(t)) for i, t in rows]).items() if i == root}
    docs = make_docs(rows).withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit("clash"))
    kept = sh.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)
    again = sh.one_per_group(make_docs([(1, "q w e"), (1, "q w e"), (2, "q w e"), (3, None)]))
    assert sorted(r["doc_id"] for r in again.collect()) == [1, 3]


def test_repeated_ids_are_judged_by_row(make_docs):
    base = [f"w{i}" for i in range(3000)]
    near = " ".join(base[:1500] + ["edit"] + base[1501:])
    base = " ".join(base)
    assert (brute_simhash(base) ^ brute_simhash(near)).bit_count() <= 2
    rows = [(3, base), (3, near), (3, near), (5, base), (5, "one of its own kind"), (7, "one of its own kind"),
            (3, "led by three as well"), (4, "led by three as well"), (8, None), (8, ""), (8, " "), (None, base)]
    docs = make_docs(rows * 2).withColumn("fp", F.lit("clash")).withColumn("root", F.lit(None).cast("date"))
    kept = sh.one_per_group(docs)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    lead = min([(brute_simhash(t) - ((1 << 64) if brute_simhash(t) >> 63 else 0), t) for t in (base, near)])[1]
    got = sorted([(r["doc_id"] or -1, r["text"] or "") for r in kept.collect()])
    assert got == sorted([(-1, base), (-1, base), (3, lead), (3, "led by three as well"), (5, "one of its own kind"), (8, "")])
