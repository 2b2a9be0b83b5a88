from collections import Counter

import pytest
from pyspark.sql import functions as F

from dealhouse.llm import merkle
from llm_brute import merkle as plain

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def rows_of(df):
    return Counter(tuple(r) for r in df.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


def check(spark, rows):
    got = rows_of(merkle.manifest(spark.createDataFrame(rows, SCHEMA)))
    assert got == plain(rows)
    return got


def test_runs_of_every_length_and_several_rounds(spark):
    """Sources of 1 to 10 leaves, of a block more or less one, and of two rounds of blocks."""
    rows = [(i, f"s{n}", "en", n, f"a\n{i}") for n in range(1, 11) for i in range(100 * n, 100 * n + n)]
    rows += [(10_000 + i, "hot", "en", 1, f"line\n{i}") for i in range(merkle.BLOCK * 4 + 1)]
    rows += [(20_000 + i, "full", "en", 1, f"line {i}") for i in range(merkle.BLOCK)]
    got = check(spark, rows)
    verified = Counter(k[-1] for k in got)
    assert verified[True] > 0 and verified[False] > 0


def test_three_rounds_of_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", merkle.ARITY)
    check(spark, [(i, "ab"[i % 5 == 0], "en", 1, f"x\n{i}") for i in range(100)])


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (None, "", "", 0, ""), (4, "é", "de", 2, "ä\n"),
            (4, "é", "de", 2, "ä\n"), (4, "é", "de", 2, "b"), (6, "z", None, None, "\n\n"), (8, "z", "en", 3, None)]
    check(spark, rows)


def test_an_empty_table(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_text_and_clashing_columns(spark):
    rows = [(i, "s", "en", 1, "word\n" * 300_000 if i == 2 else "x") for i in range(5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    clashing = ["tree", "block", "pos", "n", "node", "leaf", "other", "above", "subroot", "root", "left", "_at", "_tie", "_part"]
    assert rows_of(merkle.manifest(docs.select("*", *(F.lit(7).alias(c) for c in clashing)))) == plain(rows)


def test_a_state_resumes_where_it_was_copied():
    block = merkle.Subtree(["a" * 64, "b" * 64, "c" * 64, "d" * 64], 2)
    for at, node in enumerate(block.levels[0]):
        assert block.fold(at, node, block.path(at)) == block.top
    changed = merkle.Subtree(["a" * 64, "e" * 64, "c" * 64, "d" * 64], 2)
    assert block.fold(1, "e" * 64, block.path(1)) == changed.top


@pytest.mark.parametrize(("n", "levels"), [(1, 0), (2, 1), (3, 1), (4, 2), (9, 2), (10, 3)])
def test_height(n, levels):
    assert merkle.height(n) == levels
