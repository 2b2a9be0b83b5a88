"""Quality rules against plain Python counts and DuckDB."""
from __future__ import annotations

import random
import re

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from dealhouse.llm import quality

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    twice = {w for w in windows if windows.count(w) > 1}
    hit = {i + k for i, w in enumerate(windows) if w in twice for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def corpus():
    rng = random.Random(6)
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "a"), (4, "a b c d e f g h " * 3), (5, "x " * 40)]
    for i in range(6, 90):
        words = rng.choice([["the", "of", "ab#", "é😀", "c\n", "\n", "\x0b", "the of"], [f"w{k}" for k in range(200)]])
        rows.append((i, " ".join(rng.choice(words) for _ in range(rng.choice([7, 8, 9, 30, 120])))))
    phrase = "and the river of the stone is in the wall"
    rows += [(90, f"{phrase} one {phrase} two"), (90, f"{phrase} one {phrase} two"), (None, "the a of to " * 9)]
    return rows


def test_counts_equal_brute_force(make_docs):
    rows = corpus()
    docs = make_docs(rows).withColumn("words", F.lit("clash")).withColumn("n_words", F.lit(-1))
    got = quality.judge(docs).collect()
    assert sorted(((r["doc_id"], *(r[c] for c in COUNTS)) for r in got), key=str) == sorted(
        ((i, *brute(t)) for i, t in rows), key=str)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_equals_sql(make_docs):
    docs = make_docs(corpus())
    documents = pd.DataFrame([(r["doc_id"], r["text"]) for r in docs.collect()], columns=["doc_id", "text"])
    with duckdb.connect() as con:
        con.register("documents", documents.astype({"doc_id": "Int64"}))
        want = con.execute(quality.oracle_sql()).fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in quality.judge(docs).collect())


def test_verdicts(make_docs):
    rng = random.Random(9)
    clean = ". ".join(" ".join(rng.choice(["the", "river", "of", "stone", "is", "wall", "green", "and", "tree", "old"])
                               + (str(rng.randrange(9)) if rng.random() < .5 else "") for _ in range(9)) for _ in range(12))
    rows = [(1, clean), (2, clean.replace(" ", "%%% ")), (3, "short text"), (4, " ".join(f"q{i}" for i in range(80))),
            (5, "\n".join(["the same line is here"] * 9 + [clean]))]
    got = {r["doc_id"]: (r["kept"], r["failed_rules"]) for r in quality.judge(make_docs(rows)).collect()}
    assert got[1] == (True, "")
    assert not any(got[i][0] for i in (2, 3, 4, 5))
    assert "symbols" in got[2][1] and "stop_words" in got[4][1]


def test_one_projection_and_no_user_function(make_docs):
    plan = quality.judge(make_docs(corpus()))._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Python|Arrow|Join|Aggregate|Window", plan)


def test_empty_table(make_docs):
    assert quality.judge(make_docs([])).count() == 0
