"""SentencePiece encoding and decoding: best-scoring segmentation in one pass.

An Aho-Corasick automaton over all pieces reads a text once; at each position its output
links name every piece that ends there, and each relaxes the best score of that position
(Viterbi). Characters without a piece cost the unknown score and become byte pieces, so
decoding gives the text back exactly.

No piece reaches over the end of a word (checked when the vocabulary is loaded), so the
best path of a text is that of its words one after another, and words that recur are
segmented once per task.
"""
from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dealhouse.llm.common import map_rows

SPACE = "▁"
WORD = re.compile(r" +[^ ]*")
LITERAL = "\ud800"  # stands for a SPACE sign of the text itself; no valid text and no piece holds it
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 200_000
CACHED_LENGTH = 64


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id, their scores, and which of them are plain text or bytes."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    plain: tuple[bool, ...]
    bytes_: tuple[int, ...]  # the byte that a piece stands for, or -1
    unknown: int

    @classmethod
    def load(cls, model_file: str) -> Vocabulary:
        """Read a SentencePiece model file (on the driver; it is not an input table)."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(sp.get_piece_size())
        plain = [not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) for i in ids]
        return cls(tuple(sp.id_to_piece(i) for i in ids), tuple(sp.get_score(i) for i in ids), tuple(plain),
                   tuple(int(sp.id_to_piece(i)[3:5], 16) if sp.is_byte(i) else -1 for i in ids), sp.unk_id())


def default_model() -> str:
    """The installed public 32k model."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Encoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        import ahocorasick

        v = vocabulary
        self.pieces, self.bytes_, self.unknown = v.pieces, v.bytes_, v.unknown
        self.byte_ids = {b: i for i, b in enumerate(v.bytes_) if b >= 0}
        plain = [i for i, ok in enumerate(v.plain) if ok and v.pieces[i]]
        self.singles = {v.pieces[i] for i in plain if len(v.pieces[i]) == 1}
        self.unknown_score = min((v.scores[i] for i in plain), default=0.0) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for i in plain:
            self.automaton.add_word(v.pieces[i], (i, len(v.pieces[i]), v.scores[i]))
        self.automaton.make_automaton()
        self.by_words = not any(re.search(f"[^{SPACE}]{SPACE}", v.pieces[i]) for i in plain)
        self.known: dict[str, bytes] = {}  # ids of words, packed; a key goes without its first space
        self.shown = [bytes([b]) if b >= 0 else p.replace(SPACE, " ").encode() for p, b in
                      zip(v.pieces, v.bytes_, strict=True)]

    def _best(self, keys: list[str]) -> list[bytes]:
        """The best path's packed ids for each of ``keys``, in one pass over them all.

        No piece may reach from one key into the next. Pieces come in the order of their ends,
        so a score is final before it is built on; longer pieces win ties."""
        words = [f" {k}".replace(SPACE, LITERAL).replace(" ", SPACE) for k in keys]
        text = "".join(words)
        n = len(text)
        score, back = [0.0] + [float("-inf")] * n, [None] * (n + 1)
        ends = self.automaton.iter(text) if self.automaton.kind else iter(())
        if self.singles.issuperset(text):  # every position can be reached by pieces alone
            for at, found in ends:
                total = score[at + 1 - found[1]] + found[2]
                if total > score[at + 1]:
                    score[at + 1], back[at + 1] = total, found
        else:
            at, found = next(ends, (n, None))
            for end in range(1, n + 1):
                while at == end - 1 and found is not None:
                    total = score[end - found[1]] + found[2]
                    if total > score[end]:
                        score[end], back[end] = total, found
                    at, found = next(ends, (n, None))
                if text[end - 1] not in self.singles and score[end - 1] + self.unknown_score > score[end]:
                    score[end], back[end] = score[end - 1] + self.unknown_score, None
        packed, path, end = [], [], n
        for word in reversed(words):
            start = end - len(word)
            while end > start:
                found = back[end]
                path += self._spelled(text[end - 1]) if found is None else found[:1]
                end -= 1 if found is None else found[1]
            packed.append(array("i", path[::-1]).tobytes())
            path = []
        return packed[::-1]

    def _spelled(self, char: str) -> list[int]:
        """A character's byte pieces, last byte first; the unknown piece if there are none."""
        raw = (SPACE if char == LITERAL else char).encode("utf-8", "surrogatepass")
        if all(b in self.byte_ids for b in raw):
            return [self.byte_ids[b] for b in reversed(raw)]
        return [self.unknown]

    def _learn(self, keys: list[str]) -> dict[str, bytes]:
        """Packed ids of keys that are not known yet; short ones are remembered."""
        together = [k for k in keys if k and k[-1] != " "]  # others could merge with the space that follows
        found = dict(zip(together, self._best(together), strict=True)) if together else {}
        for k in keys:
            if k not in found:
                found[k] = self._best([k])[0]
        if len(self.known) + len(found) > CACHED_WORDS:
            self.known.clear()
        self.known.update((k, p) for k, p in found.items() if len(k) <= CACHED_LENGTH)
        return found

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of the best path for ``text``; none for null or empty."""
        if not text:
            return np.zeros(0, dtype=np.int32)
        keys = text.split(" ") if self.by_words else [text]
        if self.by_words and "" in keys:  # spaces in a row belong to the word after them
            keys = [w[1:] for w in WORD.findall(" " + text)]
        paths = list(map(self.known.get, keys))
        if None in paths:
            found = self._learn(list(dict.fromkeys(k for k, p in zip(keys, paths, strict=True) if p is None)))
            paths = [found[k] if p is None else p for k, p in zip(keys, paths, strict=True)]
        return np.frombuffer(b"".join(paths), dtype=np.int32)

    def decode(self, ids) -> str:
        """The text of ``ids``; bytes that are no valid text become replacement signs."""
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        return b"".join(map(self.shown.__getitem__, ids)).decode("utf-8", "replace")[1:]


ENCODED_FIELDS = [
    T.StructField("n_chars", T.LongType()), T.StructField("n_pieces", T.LongType()),
    T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded_sha256", T.StringType()),
    T.StructField("round_trip", T.BooleanType())]


def encode_documents(docs: DataFrame, model_file: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and, per row, the whole text's piece ids and what they decode to.

    ``round_trip`` says whether decoding gave the text back. Null and empty texts have no
    pieces; the digest is that of the decoded text, an empty one for them.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model_file or default_model()))
    keep = tuple(keep)

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        encoder = Encoder(vocabulary.value)
        for *kept, text in source:
            text = text or ""
            ids = encoder.encode(text)
            decoded = encoder.decode(ids)
            yield (*kept, len(text), len(ids), ids,
                   hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest(), decoded == text)

    return map_rows(docs, [*keep, "text"], rows, T.StructType([*(docs.schema[c] for c in keep), *ENCODED_FIELDS]))


def decode_ids(encoded: DataFrame, model_file: str | None = None) -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, ids)``; null ids give an empty text."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(Vocabulary.load(model_file or default_model()))

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        encoder = Encoder(vocabulary.value)
        for doc_id, ids in source:
            yield doc_id, encoder.decode(ids or [])

    return map_rows(encoded, ["doc_id", "ids"], rows, T.StructType([
        encoded.schema["doc_id"], T.StructField("text", T.StringType())]))
