"""Encoding against a plain dynamic programme over all substrings, and exact round trips."""
from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from dealhouse.llm import pieces as pc


@pytest.fixture(scope="module")
def vocabulary():
    return pc.Vocabulary.load(pc.default_model())


@pytest.fixture(scope="module")
def encoder(vocabulary):
    return pc.Encoder(vocabulary)


def brute_score(v, text):
    """Best score over all segmentations of the whole text, words not taken apart."""
    score = {p: v.scores[i] for i, p in enumerate(v.pieces) if v.plain[i]}
    unknown = min(score.values()) - pc.UNKNOWN_PENALTY
    best = [0.0] + [float("-inf")] * len(text)
    longest = max(map(len, score))
    for e in range(1, len(text) + 1):
        for s in range(max(0, e - longest), e):
            if text[s:e] in score:
                best[e] = max(best[e], best[s] + score[text[s:e]])
        if text[e - 1] not in score:
            best[e] = max(best[e], best[e - 1] + unknown)
    return best[-1]


def path_score(v, ids):
    """Score of a path; the byte pieces of one character cost the unknown score once."""
    unknown = min(s for s, p in zip(v.scores, v.plain, strict=True) if p) - pc.UNKNOWN_PENALTY
    starts = [i for i in ids if v.bytes_[i] >= 0 and v.bytes_[i] & 0xC0 != 0x80]
    return sum(v.scores[i] for i in ids if v.bytes_[i] < 0) + unknown * len(starts)


def texts():
    rng = random.Random(12)
    alphabet = ["the", "ing", " ", "  ", "é", "ß", "\n", "\t", "😀", "語", "a", "tion", ".", "0", "\x00", "Ω"]
    return ["", " ", "a", "  a  ", "the end", "\n\n"] + [
        "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(150)]


def test_best_path(vocabulary, encoder):
    assert encoder.by_words
    for text in texts():
        if text:
            want = brute_score(vocabulary, (" " + text).replace(" ", pc.SPACE))
            assert path_score(vocabulary, encoder.encode(text)) == pytest.approx(want), text


def test_round_trip(encoder):
    for text in [*texts(), pc.SPACE, f"a{pc.SPACE} b{pc.SPACE}", "<0x41><s></s><unk>", "x" * 50_000, "é " * 9000]:
        assert encoder.decode(encoder.encode(text)) == text


def test_words_apart_are_the_whole(encoder, vocabulary):
    whole = pc.Encoder(vocabulary)
    whole.by_words = False
    for text in texts():
        assert encoder.encode(text).tolist() == whole.encode(text).tolist()


def test_vocabulary_with_pieces_over_words_and_no_bytes():
    v = pc.Vocabulary(("<unk>", "▁a", "b", "b▁a", "▁"), (0.0, -1.0, -1.0, -1.5, -1.0), (False, True, True, True, True),
                      (-1,) * 5, 0)
    e = pc.Encoder(v)
    assert not e.by_words
    assert e.encode("ab a").tolist() == [1, 3]
    assert e.encode("z").tolist() == [4, 0]


def test_documents(spark, make_docs):
    rows = [(i, t) for i, t in enumerate(texts()[:60])] + [(900, None), (900, None), (None, "id")]
    docs = make_docs(rows).withColumn("ids", F.lit("clash")).withColumn("n_pieces", F.lit("clash"))
    got = pc.encode_documents(docs)
    out = got.collect()
    assert len(out) == len(rows) and all(r["round_trip"] for r in out)
    back = {r["doc_id"]: r["text"] for r in pc.decode_ids(got).collect()}
    assert back == {i: t or "" for i, t in rows}
    assert pc.encode_documents(make_docs([])).count() == 0
