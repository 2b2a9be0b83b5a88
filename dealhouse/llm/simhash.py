"""SimHash near-duplicate groups over an inverted index of positional bytes.

A fingerprint is eight bytes. Two fingerprints that differ in at most two bits share
at least six of their eight positional bytes: that is the guaranteed minimum of the
count filter. One posting per single (position, byte) would hold every 256th
fingerprint, so a posting is the meeting of several single-byte postings: first of
four positions (six families; two differing bytes always leave one family whole),
and where such a posting is long, of six positions, then of those plus nibbles and bit
pairs. Each step multiplies a member by six and leaves half of the free bits, so no
posting has to be paired beyond ``max_posting`` members, and the pairs found are the
same as those of the single-byte index. A pair's shared positional bytes are tallied,
pairs under the minimum fall away, and the rest are verified bit by bit.

Copies (equal fingerprints) collapse before anything is indexed.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealhouse.llm.common import map_rows, materialize
from dealhouse.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
MAX_POSTING = 64
HASH_SEED = 42
# Shingles hashed at once; bounds memory for very long texts.
BLOCK = 1 << 15
BYTE_AT = np.arange(8) * 256
BITS_OF_BYTE = (np.arange(256)[:, None] >> np.arange(8)) & 1


def simhash(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit majority fingerprint of a text's word shingles, as an unsigned integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    k = min(shingle_words, len(words))
    n = len(words) - k + 1
    bytes_seen = np.zeros(8 * 256, dtype=np.int64)  # how often each byte value stands at each place of a hash
    for at in range(0, n, BLOCK):
        part = words[at:at + BLOCK + k - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(k)), strict=False))
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, HASH_SEED) for s in shingles), dtype="<u8")
        places = hashes.view(np.uint8).reshape(-1, 8) + BYTE_AT
        bytes_seen += np.bincount(places.ravel(), minlength=len(bytes_seen))
    ones = (bytes_seen.reshape(8, 256) @ BITS_OF_BYTE).ravel()
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def as_long(fp: int) -> int:
    return fp - (1 << 64) if fp >> 63 else fp


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp)`` per row of ``docs``; ``fp`` is the fingerprint as a signed long."""
    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in source:
            yield doc_id, as_long(simhash(text, shingle_words))

    schema = T.StructType([docs.schema["doc_id"], T.StructField("fp", T.LongType())])
    return map_rows(docs, ["doc_id", "text"], rows, schema)


def posting_families(levels: int = 4) -> list[list[tuple[int, int, int]]]:
    """Per level, ``(parent, family, mask)``: the bits that a posting of the family shares.

    A family's free bits are cut into four blocks in order (two bytes, a byte, a
    nibble, two bits) and each child fixes two of the four.
    """
    out, last = [], [(0, 0, 0)]
    for _ in range(levels):
        found = []
        for _, parent, mask in last:
            free = [i for i in range(64) if not mask >> i & 1]
            size = len(free) // 4
            blocks = [sum(1 << i for i in free[k * size:(k + 1) * size]) for k in range(4)]
            for x, y in combinations(range(4), 2):
                found.append((parent, len(found), mask | blocks[x] | blocks[y]))
        out.append([(p, f, as_long(m)) for p, f, m in found])
        last = found
    return out


def shared_bytes(a: str, b: str) -> F.Column:
    """How many of the eight positional bytes two fingerprints share."""
    differ = F.col(a).bitwiseXOR(F.col(b))
    return sum((F.shiftrightunsigned(differ, 8 * i).bitwiseAND(F.lit(255)) == 0).cast("int") for i in range(8))


def link_fingerprints(fps: DataFrame, max_bits: int = MAX_BITS, max_posting: int = MAX_POSTING) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of distinct fingerprints (``fp``) within ``max_bits`` (two at most) bits."""
    if max_bits > 2:
        raise ValueError("the posting families guarantee a meeting for at most two differing bytes")
    families = posting_families()
    open_members = fps.select("fp").withColumn("parent", F.lit(0))
    found = None
    for level, family in enumerate(families):
        children = [[F.struct(F.lit(f).alias("family"), F.lit(m).cast("long").alias("mask")) for p, f, m in family if p == parent]
                    for parent in range(family[-1][0] + 1)]  # fixed: six per family of the level before
        posts = (open_members
                 .select("fp", F.explode(F.get(F.array(*[F.array(*c) for c in children]), F.col("parent"))).alias("at"))
                 .select("at.family", F.col("fp").bitwiseAND(F.col("at.mask")).alias("key"), "fp"))
        sizes = posts.groupBy("family", "key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
        posts = materialize(posts.join(sizes, ["family", "key"]), f"postings-{level}")
        last = level + 1 == len(families)  # four free bits: at most sixteen members
        short = posts if last else posts.filter(F.col("members") <= max_posting)
        pairs = (short.select("family", "key", F.col("fp").alias("a"))
                 .join(short.select("family", "key", F.col("fp").alias("b")), ["family", "key"])
                 .filter("a < b")
                 .filter(shared_bytes("a", "b") >= 8 - max_bits)
                 .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
                 .select("a", "b"))
        found = pairs if found is None else found.unionByName(pairs)
        if last:
            break
        open_members = posts.filter(F.col("members") > max_posting).select("fp", F.col("family").alias("parent"))
        if open_members.isEmpty():
            break
    return found.distinct()


def components(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
               max_posting: int = MAX_POSTING) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, fp)`` per row of ``docs``, and ``(fp, root, component_id)`` per fingerprint.

    ``root`` is a component's smallest fingerprint, its identity: where doc_ids repeat, two components may have
    the same smallest doc_id."""
    marked = materialize(fingerprints(docs, shingle_words), "simhash")
    classes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    roots = connected_components(link_fingerprints(classes, max_bits, max_posting), "a", "b", "simhash-links")
    placed = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked, placed.join(named, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    max_posting: int = MAX_POSTING) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row of ``docs``.

    ``component_id`` is the smallest doc_id that links of at most ``max_bits`` differing
    bits reach. A null or word-free text has fingerprint zero and links like any other;
    repeated rows stay repeated; a null doc_id never names a component unless all its
    members are null; an empty table gives an empty table.
    """
    marked, placed = components(docs, shingle_words, max_bits, max_posting)
    return marked.join(placed, "fp").select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                  max_posting: int = MAX_POSTING) -> DataFrame:
    """The rows of ``docs``, less all but one row of each near-duplicate group: one with its smallest doc_id.

    Where several rows of a group have that doc_id, the one with the smallest fingerprint stays, of equal
    fingerprints the one with the smallest text (null first). A doc_id that repeats in several groups is judged
    in each of them. Rows without a doc_id cannot be named by a group and pass unchanged.
    """
    marked, placed = components(docs, shingle_words, max_bits, max_posting)
    groups = marked.filter("doc_id is not null").join(placed, "fp")
    ids = groups.groupBy("doc_id").agg(
        F.max(F.col("doc_id") == F.col("component_id")).alias("_stays"), F.count(F.lit(1)).alias("_rows"))
    odd = materialize(ids.filter("not _stays or _rows > 1").withColumnRenamed("doc_id", "_odd_id"), "simhash-odd")
    joined = docs.join(odd, docs["doc_id"] == F.col("_odd_id"), "left")
    kept = joined.filter("_rows is null").select(docs.columns)
    repeated = odd.filter("_stays").select(F.col("_odd_id").alias("doc_id"))
    if repeated.isEmpty():
        return kept
    leads = (groups.join(repeated, "doc_id", "left_semi").filter("doc_id = component_id")
             .groupBy("root", "doc_id").agg(F.min("fp").alias("_lead_fp"))
             .select(F.col("doc_id").alias("_lead_id"), "_lead_fp"))
    leads = materialize(leads, "simhash-leads")

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for *row, text in source:
            yield *row, as_long(simhash(text, shingle_words))

    # Copies of a row collapse in their tasks before they meet
    again = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text").join(
        repeated.withColumnRenamed("doc_id", "_odd_id"), F.col("doc_id") == F.col("_odd_id"), "left_semi")
    with_fp = map_rows(again.select("_row", "doc_id", F.col("text").alias("_order"), "text"),
                       ["_row", "doc_id", "_order", "text"], rows, T.StructType([
                           T.StructField("_row", docs.schema), T.StructField("_lead_id", docs.schema["doc_id"].dataType),
                           T.StructField("_order", T.StringType()), T.StructField("_lead_fp", T.LongType())]))
    chosen = (with_fp.join(leads, ["_lead_id", "_lead_fp"]).groupBy("_lead_id", "_lead_fp")
              .agg(F.min_by("_row", F.struct("_order")).alias("_row")))
    return kept.unionByName(chosen.select("_row.*"))
