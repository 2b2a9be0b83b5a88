"""Byte-level BPE encoding and decoding through a SentencePiece model made from a rank file.

The vocabulary of byte strings is serialised as a SentencePiece BPE model: each byte is
mapped to a character, a piece scores minus its rank, and the model normalises nothing. Its
merges, best score first and leftmost among equals, are then those of the ranks. A text is
split into pre-tokens, each is encoded by itself, and decoding maps ids back to bytes.
"""
from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealhouse.llm.common import map_rows

ID_BYTES = 4  # an id is packed as a little-endian unsigned 32-bit integer
CACHED = 300_000
CACHED_LENGTH = 64
TOGETHER = 1 << 20  # characters of texts that are encoded in one go
BETWEEN = "\ud800"  # parts pre-tokens; no valid text holds it
BETWEEN_BYTES = BETWEEN.encode("utf-8", "surrogatepass")
CUT = re.compile(r"(?<=\S) (?=\S)")
DECODED_AT_ONCE = 1 << 16

#: Visible ASCII characters stand for their own bytes, the other bytes for characters from U+0100 on.
ALPHABET = "".join(chr(b) if 0x21 <= b <= 0x7E else chr(0x100 + b) for b in range(256))
TO_ALPHABET = {b: ALPHABET[b] for b in range(256)}


def mapped(raw: bytes) -> str:
    return raw.decode("latin-1").translate(TO_ALPHABET)


def default_ranks() -> str:
    """The installed public rank file for many languages."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, read on the driver: a vocabulary is no input table."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


# Protocol buffer wire format: a field is its number and kind, then a varint, a length or four bytes.
VARINT, LENGTH, FIXED32 = 0, 2, 5
NORMAL, UNKNOWN, BPE = 1, 2, 2


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, kind: int, value) -> bytes:
    head = _varint(number << 3 | kind)
    if kind == VARINT:
        return head + _varint(value)
    if kind == FIXED32:
        return head + struct.pack("<f", value)
    return head + _varint(len(value)) + value


def _piece(text: str, score: float, kind: int) -> bytes:
    """Field 1 of a model: piece 1, score 2, type 3."""
    return _field(1, LENGTH, _field(1, LENGTH, text.encode()) + _field(2, FIXED32, score) + _field(3, VARINT, kind))


def serialise(tokens: Iterable[bytes]) -> bytes:
    """A SentencePiece BPE model whose ids are the places of ``tokens``, best rank first.

    The unknown piece that every model needs comes last; as each byte is a token, no text
    leads to it.
    """
    tokens = list(tokens)
    missing = sorted(set(range(256)) - {t[0] for t in tokens if len(t) == 1})
    if missing:
        raise ValueError(f"the vocabulary lacks {len(missing)} single bytes, {missing[0]:#04x} among them")
    pieces = [_piece(mapped(token), -float(place), NORMAL) for place, token in enumerate(tokens)]
    pieces.append(_piece("<unk>", -float(len(tokens)), UNKNOWN))
    trainer = _field(3, VARINT, BPE) + b"".join(
        _field(number, VARINT, id_ & (1 << 64) - 1)  # ids of the unknown, begin, end and padding pieces
        for number, id_ in ((40, len(tokens)), (41, -1), (42, -1), (43, -1)))
    normaliser = _field(1, LENGTH, b"identity") + b"".join(
        _field(number, VARINT, 0) for number in (3, 4, 5))  # no leading space, none removed, none escaped
    return b"".join(pieces) + _field(2, LENGTH, trainer) + _field(3, LENGTH, normaliser)


def _closed(word: str) -> bool:
    """Whether a word has a visible character at both ends."""
    return bool(word) and not word[0].isspace() and not word[-1].isspace()


class Encoder:
    """Texts to ids and back for one vocabulary; ids are the ranks of the rank file.

    A pre-token starts at every single space between two visible characters, whatever stands
    around it. So a text is first cut there into words, which recur, and only words that are
    not remembered are split into pre-tokens, all new ones of many texts at once.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, model: bytes) -> None:
        import regex
        import sentencepiece

        self.split = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        tokens = sorted(ranks, key=ranks.__getitem__)
        self.ids = np.array([ranks[t] for t in tokens], dtype="<u4")
        self.bytes_of = {ranks[t]: t for t in tokens}
        # A pre-token that is a token as a whole is that token, even if merges lead elsewhere.
        self.unmerged = {mapped(tokens[at]): [at] for at, path in enumerate(
            self.model.encode(list(map(mapped, tokens)), num_threads=1)) if path != [at]}
        self.words: dict[str, bytes] = {}  # packed ids of closed words, each after its space

    def _pre_tokens(self, words: list[str]) -> tuple[list[str], list[int]]:
        """The pre-tokens of ``words`` in a row, and where those of each word begin."""
        if all(w[:1] == " " and w.count(" ") == 1 and _closed(w[1:]) for w in words):
            tokens = self.split("".join(words))
            return tokens, [at for at, t in enumerate(tokens) if t[0] == " "]
        tokens, begin = [], []
        for w in words:
            begin.append(len(tokens))
            tokens += self.split(w)
        return tokens, begin

    def _encode_words(self, words: list[str]) -> list[bytes]:
        tokens, begin = self._pre_tokens(words)
        if not tokens:
            return [b""] * len(words)
        shown = mapped(BETWEEN.join(tokens).encode("utf-8", "surrogatepass")).split(mapped(BETWEEN_BYTES))
        paths = self.model.encode(shown, num_threads=1)
        if self.unmerged:
            paths = [self.unmerged.get(t, path) for t, path in zip(shown, paths, strict=True)]
        ends = np.cumsum(np.fromiter(map(len, paths), dtype=np.int64, count=len(paths))) * ID_BYTES
        packed = self.ids[np.fromiter(chain.from_iterable(paths), dtype=np.int64)].tobytes()
        cuts = [0, *ends.tolist()]
        return [packed[cuts[a]:cuts[b]] for a, b in zip(begin, [*begin[1:], len(tokens)], strict=True)]

    def _cut(self, text: str) -> tuple[list[str], list[str]]:
        """The words of ``text``, and those after the first that are not remembered."""
        words = text.split(" ")
        new = [w for w in words[1:] if w not in self.words]
        if len(words) > 1 and not (words[0] and not words[0][-1].isspace() and all(map(_closed, new))):
            words = CUT.split(text)  # some space stands next to white space
            new = [w for w in words[1:] if w not in self.words]
        return words, new

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The packed ids of each of ``texts``; none for null or empty."""
        if len(self.words) > CACHED:
            self.words.clear()
        cut, new = [], {}
        for text in texts:
            words, unknown = self._cut(text or "")
            cut.append(words)
            new.update(dict.fromkeys(unknown))
        closed = [w for w in new if " " not in w and _closed(w)]
        open_ = [w for w in new if " " in w or not _closed(w)]
        found = {w: p for some in (closed, open_)
                 for w, p in zip(some, self._encode_words([" " + w for w in some]), strict=True)}
        self.words.update((w, found[w]) for w in closed if len(w) <= CACHED_LENGTH)
        out = []
        for words, first in zip(cut, self._encode_words([words[0] for words in cut]), strict=True):
            paths = list(map(self.words.get, words[1:]))
            if None in paths:
                paths = [found[w] if p is None else p for w, p in zip(words[1:], paths, strict=True)]
            out.append(first + b"".join(paths))
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, packed: bytes | None) -> bytes:
        """The bytes that packed ids stand for; an id outside the vocabulary is an error."""
        ids, step = memoryview(packed or b""), DECODED_AT_ONCE * ID_BYTES
        return b"".join(
            b"".join(map(self.bytes_of.__getitem__, struct.unpack(f"<{len(part) // ID_BYTES}I", part)))
            for part in (ids[at:at + step] for at in range(0, len(ids), step)))


def _vocabulary(spark: SparkSession, ranks_file: str | None):
    """What a task makes its encoder from; a few megabytes, by the size of the vocabulary."""
    ranks = load_ranks(ranks_file or default_ranks())
    return spark.sparkContext.broadcast(
        (ranks, default_pattern(), serialise(sorted(ranks, key=ranks.__getitem__))))


def _by_length(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
    """``rows`` in lists whose last columns, texts, hold ``TOGETHER`` characters or little more."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or "")
        if size >= TOGETHER:
            yield held
            held, size = [], 0
    yield held


def encode_documents(docs: DataFrame, ranks_file: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, ``n_tokens``, and the whole text's packed ids as binary ``ids``.

    Null and empty texts have no ids. Special tokens do not exist: their strings are text.
    Repeated rows are encoded one by one; columns beside ``keep`` and text are not looked at.
    """
    vocabulary = _vocabulary(docs.sparkSession, ranks_file)
    keep = tuple(keep)

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        encoder = Encoder(*vocabulary.value)
        for held in _by_length(source):
            for (*kept, _), ids in zip(held, encoder.encode_all([r[-1] for r in held]), strict=True):
                yield (*kept, len(ids) // ID_BYTES, ids)

    return map_rows(docs, [*keep, "text"], rows, T.StructType(
        [*(docs.schema[c] for c in keep), T.StructField("n_tokens", T.LongType()),
         T.StructField("ids", T.BinaryType())]))


def decode_documents(encoded: DataFrame, ranks_file: str | None = None,
                     keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``decoded``, the bytes that ``ids`` stand for; null ids give none."""
    vocabulary = _vocabulary(encoded.sparkSession, ranks_file)
    keep = tuple(keep)

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        decoder = Encoder(*vocabulary.value)
        for *kept, ids in source:
            yield (*kept, decoder.decode(ids))

    return map_rows(encoded, [*keep, "ids"], rows, T.StructType(
        [*(encoded.schema[c] for c in keep), T.StructField("decoded", T.BinaryType())]))


def round_trip(docs: DataFrame, ranks_file: str | None = None) -> DataFrame:
    """Digests of every row's ids and of the bytes they decode to, beside the number of ids."""
    encoded = encode_documents(docs, ranks_file).withColumn("ids_sha256", F.sha2("ids", 256))
    decoded = decode_documents(encoded, ranks_file, keep=("doc_id", "n_tokens", "ids_sha256"))
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
