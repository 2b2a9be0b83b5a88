"""Lempel-Ziv phrase fingerprints.

A text is parsed left to right into dictionary phrases (LZ78: each phrase is the
shortest string not seen as a phrase before). The phrase set is hashed and the
``SIGNATURE`` smallest hashes are the fingerprint; two fingerprints are compared as
minimum-hash signatures, which estimates the Jaccard likeness of the phrase sets, a
measure akin to a compression distance. Phrase sets under the signature size are
compared exactly.

A parse walks a trie of phrases, one step a character, and notes only where phrases end.
All phrases are hashed at once: a phrase's polynomial is the difference of two running sums
over the text, which numpy takes for all of them, and a finaliser spreads its bits.

The neighbour comparison walks documents in descending doc_id. Texts are shuffled once, into
ranges of (doc_id, text hash), so that rows of one id, or of none, are spread as well. A
range is walked by itself. Its first row and its last one, whose neighbour begins the next
range, are written beside the results and meet in a join by range; no row travels twice and
the driver sees none.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealhouse.llm.common import map_rows, materialize

SIGNATURE = 64
HASH = np.dtype(">u4")       # how a hash is written: eight hexadecimal digits
BASE = 0x9E3779B97F4A7C15    # odd, so that it has an inverse modulo 2^64
UNBASE = pow(BASE, -1, 1 << 64)

FINGERPRINT_FIELDS = [
    T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
    T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
    T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())]


Trie = dict  # character -> Trie, or LEAF for a phrase that no other phrase goes on from
LEAF = 0


class Parse:
    """A parse that can go on with more text, and go back to where a text began to differ."""

    def __init__(self) -> None:
        self.root: Trie = {}
        self.node = self.root
        self.added: list[tuple[Trie, str]] = []

    def feed(self, text: str, at: int = 0) -> list[int]:
        """Positions where phrases end, if ``text`` is what stands from position ``at`` on."""
        ends: list[int] = []
        root, node = self.root, self.node
        for end, char in enumerate(text, at + 1):
            after = node.get(char)
            if after:
                node = after
            elif after is None:
                node[char] = LEAF
                self.added.append((node, char))
                ends.append(end)
                node = root
            else:
                node[char] = after = {}
                node = after
        self.node = node
        return ends

    def mark(self) -> Trie:
        """Where the open phrase stands; phrases added so far are kept by ``back``."""
        self.added.clear()
        return self.node

    def back(self, mark: Trie) -> None:
        for node, char in reversed(self.added):
            del node[char]
        self.added.clear()
        self.node = mark


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Powers:
    """Powers of ``BASE`` and of its inverse, as many as the longest text so far needed."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, dtype=np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = _powers(BASE, size), _powers(UNBASE, size)
        return self.up, self.down


POWERS = _Powers()


def phrase_hashes(text: str, ends: list[int]) -> np.ndarray:
    """32-bit hashes of the phrases of ``text`` that end at ``ends`` (the first begins at 0)."""
    if not ends:
        return np.zeros(0, dtype=np.uint32)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    up, down = POWERS.of(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((codes + np.uint64(1)) * up[:len(codes)], out=sums[1:])
    stop = np.array(ends)
    start = np.concatenate([[0], stop[:-1]])
    h = (sums[stop] - sums[start]) * down[start]
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(32)).astype(np.uint32)


def signature(hashes: np.ndarray, size: int = SIGNATURE) -> np.ndarray:
    """The ``size`` smallest distinct hashes, ascending."""
    if len(hashes) > 4 * size:  # all hashes up to a bound that leaves enough distinct ones
        few = np.unique(np.partition(hashes, 2 * size)[:2 * size])
        if len(few) >= size:
            return few[:size]
    return np.unique(hashes)[:size]


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIGNATURE) -> float:
    """Jaccard estimate from two signatures; two empty ones are alike."""
    x, y = set(a.tolist()), set(b.tolist())
    both = x & y
    least = sorted(x | y)[:size]
    return sum(h in both for h in least) / len(least) if least else 1.0


def fingerprint(text: str | None, size: int = SIGNATURE) -> np.ndarray:
    return signature(phrase_hashes(text or "", Parse().feed(text or "")), size)


class _Parsed:
    """A text's fingerprint, and its parse up to where an edit of its last half begins."""

    def __init__(self, doc_id: object, text: str | None, size: int) -> None:
        self.doc_id, self.text, self.size = doc_id, text or "", size
        self.cut = len(self.text) - len(self.text) // 2
        self.parse = Parse()
        self.head = self.parse.feed(self.text[:self.cut])
        self.open = self.parse.mark()
        ends = self.head + self.parse.feed(self.text[self.cut:], self.cut)
        self.parse.back(self.open)
        self.fingerprint = signature(phrase_hashes(self.text, ends), size)

    def against(self, text: str, sketch: np.ndarray) -> tuple:
        """The result row, if ``text`` with fingerprint ``sketch`` comes next."""
        edited = self.text[:self.cut] + text[:len(self.text) // 2]
        ends = self.head + self.parse.feed(edited[self.cut:], self.cut)
        self.parse.back(self.open)
        other = signature(phrase_hashes(edited, ends), self.size)
        return (self.doc_id, len(self.text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).digest(),
                self.fingerprint.astype(HASH).tobytes(), other.astype(HASH).tobytes(),
                likeness(self.fingerprint, other, self.size), likeness(self.fingerprint, sketch, self.size))


RESULT, FIRST, LAST = range(3)
BINARY = ("edited_sha256", "fingerprint", "edited_fingerprint")


def edited_neighbours(docs: DataFrame, size: int = SIGNATURE, ranges: int | None = None) -> DataFrame:
    """Fingerprint every row of ``docs`` (doc_id of any orderable type, text) and of its edited text.

    The edited text has the last floor(n/2) code points replaced by the first as many (or
    all) of the next document in descending doc_id; after the last comes the first, so a
    lone row is its own neighbour. Null texts count as empty; an empty text has an empty
    fingerprint, like 1 to another empty one and 0 to any other. Null ids come last; rows
    with equal ids follow one another by the hash of their text (descending XXH64; a null
    text as an empty one). Other columns are left out. ``ranges``: how many ranges there are,
    by default the session's shuffle partitions; it doesn't change the result.
    """
    spark = docs.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # "row" only lets Spark part rows that are equal in id and text, which may stand in any order
    keyed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"),
                        F.monotonically_increasing_id().alias("row"))
    order = [F.desc_nulls_last("doc_id"), F.desc("hash"), F.desc("row")]
    dealt = keyed.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    blank = (None,) * (len(FINGERPRINT_FIELDS))

    def walk(source: Iterator[tuple]) -> Iterator[tuple]:
        part = TaskContext.get().partitionId()
        first, last = True, None
        for doc_id, text in source:
            parsed = _Parsed(doc_id, text, size)
            if first:
                sketch = parsed.fingerprint.astype(HASH).tobytes()
                yield FIRST, part, parsed.text, None, None, None, sketch, None, None, None
                first = False
            else:
                yield RESULT, part, None, *last.against(parsed.text, parsed.fingerprint)
            last = parsed
        if last is not None:
            yield LAST, part, last.text, last.doc_id, *blank

    binary = [T.StructField(f.name, T.BinaryType()) if f.name in BINARY else f for f in FINGERPRINT_FIELDS]
    result = T.StructType([docs.schema["doc_id"], *binary])
    walked = materialize(map_rows(dealt, ["doc_id", "text"], walk, T.StructType([
        T.StructField("kind", T.IntegerType()), T.StructField("part", T.IntegerType()),
        T.StructField("edge", T.StringType()), *result])), "lz-walked")

    # A row of two numbers per range
    along = Window.orderBy("part")
    firsts = walked.filter(F.col("kind") == FIRST)
    follows = firsts.select("part").select(
        F.col("part").alias("from"), F.lead("part").over(along).alias("to"), F.min("part").over(
            along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("begin"))
    seams = (walked.filter(F.col("kind") == LAST).select("part", "doc_id", F.col("edge").alias("text"))
             .join(follows, F.col("part") == F.col("from"))
             .join(firsts.select(F.col("part").alias("next"), F.col("edge").alias("next_text"),
                                 F.col("fingerprint").alias("next_sketch")),
                   F.coalesce("to", "begin") == F.col("next")))

    def close(source: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text, after, sketch in source:
            yield _Parsed(doc_id, text, size).against(after, np.frombuffer(sketch, dtype=HASH))

    closed = map_rows(seams, ["doc_id", "text", "next_text", "next_sketch"], close, result)
    rows = walked.filter(F.col("kind") == RESULT).select(*result.names).unionAll(closed)
    return rows.withColumns({c: F.lower(F.hex(c)) for c in BINARY})
