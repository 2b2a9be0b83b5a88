import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealhouse.llm import spelling
from llm_brute import variants, word_counts


def counted(df):
    return {r["word"]: r["n"] for r in df.collect()}


def grouped(spark, counts, **options):
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    return {tuple(r) for r in spelling.group_variants(words, **options).collect()}


def test_words_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (None, "straße STRASSE ÉCOLE école"), (3, "Ünïcode×÷words naïve漢字kanjis œuvres ﬁnance"),
            (3, "Ünïcode×÷words naïve漢字kanjis œuvres ﬁnance"), (-4, "a1b2cdefgh ABCDEFGH-abcdefgh_abcdefg\nabcdef"),
            (5, "x" * 100_000 + " " + "Yy" * 40 + " " + "é" * 33), (6, "é"), (7, "")]
    rows += [(i, " ".join(f"{chr(97 + j % 26)}variantwörd" for j in range(60))) for i in range(100, 160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = dict(word_counts(rows))
    assert any(w.endswith("variantwrd") for w in want)  # some are misspelt
    assert counted(spelling.count_words(docs)) == want
    clashing = docs.select("*", *(F.lit(1).alias(c) for c in ("word", "n")))
    assert counted(spelling.count_words(clashing.repartition(3))) == want
    assert counted(spelling.count_words(docs.limit(0))) == {}


def test_checksums_of_short_and_long_runs():
    import zlib

    runs = sorted((b"abcdef", b"x" * 63, b"x" * 64, b"x" * 65, b"y" * 900), key=len, reverse=True)
    raw = np.frombuffer(b" ".join(runs), dtype=np.uint8)
    sizes = np.array([len(r) for r in runs])
    starts = np.cumsum([0, *(sizes[:-1] + 1)])
    seeds = np.array([zlib.crc32(b"%d:" % i) for i in range(len(runs))], dtype=np.uint32)
    assert spelling._checksums(raw, starts, sizes, seeds).tolist() == [
        zlib.crc32(b"%d:" % i + r) for i, r in enumerate(runs)]


@pytest.mark.parametrize("block", [3, 1024])
def test_groups_match_every_deletion_and_wildcard(spark, monkeypatch, block):
    """Dense random words over few letters: anagrams, one edit, two edits, both block sizes."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    rng = random.Random(block)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randrange(6, 9))) for _ in range(150)}
    counts = {w: rng.choice([4, 5, 6, 25, 30, 150, 800]) for w in words}
    assert grouped(spark, counts) == variants(counts)


def test_chains_ties_and_thresholds(spark):
    counts = {"abcdef": 5, "abcdefg": 25, "abcdefgh": 125, "abcdefghi": 625, "xbcdef": 25, "unlike": 9, "seldom": 4,
              "listen": 10, "silent": 10, "enlist": 10, "aaaaaaa": 24, "aaaaaa": 5}
    got = {r[0]: r[1:] for r in grouped(spark, counts)}
    assert got["abcdef"] == ("abcdefg", "abcdefghi", 5, 2, 25)  # a tie: the smaller word; then to the end
    assert got["abcdefghi"] == (None, "abcdefghi", 625, 1, None)
    assert got["unlike"] == (None, "unlike", 9, 0, None)
    assert got["aaaaaa"] == (None, "aaaaaa", 5, 1, None)  # 24 is not five times 5
    assert got["listen"][3] == 0  # an anagram is no near word
    assert "seldom" not in got


def test_very_long_words(spark):
    long = "ab" * 3000
    counts = {long: 100, long + "a": 9, long[:4000] + "é" + long[4001:]: 8, long[::-1]: 7}
    assert grouped(spark, counts) == variants(counts)


def test_no_words(spark):
    assert grouped(spark, {"seldom": 1}) == set()
