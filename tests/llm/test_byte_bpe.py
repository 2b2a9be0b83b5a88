import hashlib
import struct

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dealhouse.llm import byte_bpe

RANKS = byte_bpe.load_ranks(byte_bpe.default_ranks())
PLAIN = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN, byte_bpe.serialise(sorted(RANKS, key=RANKS.__getitem__)))


def packed(text):
    ids = PLAIN.encode_ordinary(text or "")
    return struct.pack(f"<{len(ids)}I", *ids)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=30), st.text(" \t\n\r\x1c\x85  'sredlvm1²Ⅷé漢🙂.,", max_size=30)))
def test_ids_are_those_of_the_merge_ranks(text):
    assert ENCODER.encode(text) == packed(text)
    assert ENCODER.decode(packed(text)) == text.encode()


@pytest.mark.parametrize("text", [
    "", " ", "  ", " a", "a ", "a  b", "a \nb", "a\n b", "a\n\nb c", "it's we'll  'S", "a b\n", "x" * 5000 + " " + "é" * 5000,
    "<|endoftext|> <s>", "1234 567,89", "▁ ▁a", "\x00\x01 ﻿"])
def test_spaces_and_odd_texts(text):
    assert ENCODER.encode_all([text, "b\n", text]) == [packed(text), packed("b\n"), packed(text)]


def test_remembered_words_are_cleared(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHED", 3)
    for text in ("one two three four five", "two four six eight", "one two three four five"):
        assert ENCODER.encode_all([text, text + " more"]) == [packed(text), packed(text + " more")]


def test_a_whole_token_wins_over_merges():
    """'abcd' is a token, but its best first merge, 'bc', leads elsewhere."""
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"ab": 257, b"cd": 258, b"abcd": 259}
    own = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN, byte_bpe.serialise(sorted(ranks, key=ranks.__getitem__)))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("abcd", "abc abcd", "abcdabcd"):
        ids = plain.encode_ordinary(text)
        assert own.encode(text) == struct.pack(f"<{len(ids)}I", *ids)


def test_a_vocabulary_without_a_byte_is_refused():
    with pytest.raises(ValueError, match="lacks 1 single bytes, 0x41"):
        byte_bpe.serialise(t for t in RANKS if t != b"A")


def test_documents(spark):
    """Null, empty, repeated and very long texts, ids that repeat or are null, clashing columns."""
    texts = [None, "", "It's 3 o'clock", "It's 3 o'clock", "wort " * 100_000, "a" * 200_000, "ÄÖ\n\tü 漢字🙂"]
    rows = [(i if i != 3 else None, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", *(F.lit("?").alias(c) for c in ("ids", "n_tokens", "decoded", "ids_sha256")))
    got = sorted((tuple(r) for r in byte_bpe.round_trip(docs).collect()), key=str)
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    assert got == sorted(((i, len(packed(t)) // 4, sha(packed(t)), sha((t or "").encode())) for i, t in rows), key=str)
    assert byte_bpe.round_trip(docs.limit(0)).count() == 0


def test_packed_ids_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    encoded = byte_bpe.encode_documents(docs)
    assert bytes(encoded.first()["ids"]) == packed("one two")
    none = encoded.withColumn("ids", F.lit(None).cast("binary"))
    assert bytes(byte_bpe.decode_documents(none).first()["decoded"]) == b""
