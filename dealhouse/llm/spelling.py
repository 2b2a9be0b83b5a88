"""Spelling variants: words one edit apart, found through Gram matrices of letter counts.

The letter counts of two words one edit apart have a squared distance of 1 (a letter more) or
at most 2 (one replaced). Words are kept in blocks of one length and one tally of letters by
class (code point modulo ``CLASSES``); an edit changes the tally of one class by one, or of
two classes by one up and one down, so a block has to meet a fixed number of neighbouring
tallies of its own length and of the next. NumPy products of two blocks' counts give all
squared distances; pairs of at most 2 are verified letter by letter.

Work per pair of blocks is bounded by ``BLOCK``; pairs of blocks are spread over all tasks.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealhouse.llm.common import bound_batches, map_rows, materialize
from dealhouse.llm.ranks import positions

MIN_LENGTH = 6
MIN_COUNT = 5
TYPO_MODULUS = 199
FORM_RATIO = 5

CLASSES = 4
BLOCK = 1024  # words
CELLS = 1 << 17  # letters of a block, for very long words
EXACT_FLOAT32 = 1 << 24
TOGETHER = 4096  # partner words in one product
TABLED = 64  # bytes of a run whose checksum is computed for all runs at once
HELD = 400_000  # distinct words that a task holds before it hands them on

LEAD = 0xC3  # first byte of U+00C0 to U+00FF in UTF-8
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), LEAD]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = _crc_table()
ALL_ONES = np.uint32(0xFFFFFFFF)


def misspelt(run: str, h: int) -> str:
    """``run`` without its code point ``h % length`` where the modulus divides ``h``."""
    if h % TYPO_MODULUS:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _checksums(low: np.ndarray, starts: np.ndarray, sizes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """crc32 of each run of ``low`` (bytes), going on from ``seeds``; sorted by size, longest first."""
    state = seeds ^ ALL_ONES
    short = int(np.searchsorted(-sizes, -TABLED))  # runs before it are longer than the table loop goes
    for at in range(int(sizes[short]) if short < len(sizes) else 0):
        upto = int(np.searchsorted(-sizes, -at))
        part = state[short:upto]
        state[short:upto] = CRC[(part ^ low[starts[short:upto] + at]) & 0xFF] ^ part >> 8
    state ^= ALL_ONES
    for i in range(short):
        state[i] = zlib.crc32(low[starts[i]:starts[i] + sizes[i]].tobytes(), int(seeds[i]))
    return state


def _words(ids: list, texts: pa.Array) -> pa.Array:
    """The words of all ``texts`` as one string array, after misspelling."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    lead = raw == LEAD
    letter = LETTER[raw]
    letter[1:] |= lead[:-1]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[offsets] = True  # a text begins or ends here
    begin, end = letter.copy(), letter.copy()
    begin[1:] &= ~letter[:-1] | edge[1:-1]
    end[:-1] &= ~letter[1:] | edge[1:-1]
    starts, sizes = np.flatnonzero(begin), np.flatnonzero(end) + 1 - np.flatnonzero(begin)
    two = np.concatenate([[0], np.cumsum(lead)])
    points = sizes - (two[starts + sizes] - two[starts])
    starts, sizes = starts[points >= MIN_LENGTH], sizes[points >= MIN_LENGTH]
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    seeds = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], dtype=np.uint32)
    low = LOWER[raw]
    owner = np.searchsorted(offsets, starts, side="right") - 1
    h = _checksums(low, starts, sizes, seeds[owner])
    hit = h % TYPO_MODULUS == 0
    changed = (misspelt(low[s:s + k].tobytes().decode(), int(x)) for s, k, x in zip(
        starts[hit].tolist(), sizes[hit].tolist(), h[hit].tolist(), strict=True))
    starts, sizes = starts[~hit], sizes[~hit]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    picked = low[np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])]
    whole = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(picked))
    return pa.concat_arrays([whole, pa.array([w for w in changed if len(w) >= MIN_LENGTH], type=pa.large_string())])


def count_words(docs: DataFrame) -> DataFrame:
    """``(word, n)``: the words of ``MIN_LENGTH`` code points or more in ``docs`` (doc_id, text).

    Runs of letters, A-Z lower-cased; where crc32 of ``<doc_id>:<run>`` is divisible by
    ``TYPO_MODULUS`` one code point is deleted. Null texts have no words; a null id counts as
    an empty one; repeated rows count each time.
    """
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def handed() -> pa.Table:
            table = pa.Table.from_batches(held).group_by("word").aggregate([("n", "sum")])
            return pa.table({"word": table["word"].cast(pa.string()), "n": table["n_sum"]})

        for batch in batches:
            found = pc.value_counts(_words(batch.column(0).to_pylist(), batch.column(1)))
            held.append(pa.RecordBatch.from_arrays([found.field(0), found.field(1)], ["word", "n"]))
            rows += len(found)
            if rows > HELD:
                yield from handed().to_batches()
                held, rows = [], 0
        if held:
            yield from handed().to_batches()

    return bound_batches(docs).select("doc_id", "text").mapInArrow(count, schema).groupBy("word").agg(
        F.sum("n").alias("n"))


def _tally(word: F.Column) -> F.Column:
    """Letters of ``word`` by class."""
    of_class = F.transform(F.split(word, ""), lambda c: F.ascii(c) % CLASSES)

    def letters_of(k: int) -> F.Column:
        return F.size(F.filter(of_class, lambda x: x == k))

    return F.array(*map(letters_of, range(CLASSES)))


def _key(tally: F.Column) -> F.Column:
    return F.concat_ws(",", tally)


def _partners(tally: F.Column) -> F.Column:
    """Of the blocks that a block with ``tally`` meets as the second one: key, and if one letter shorter."""
    def moved(step: dict[int, int]) -> F.Column:
        return _key(F.array(*[F.get(tally, k) + step.get(k, 0) for k in range(CLASSES)]))

    own = [(moved({}), False)]
    replaced = [(moved({a: 1, b: -1}), False) for a in range(CLASSES) for b in range(a)]
    shorter = [(moved({a: -1}), True) for a in range(CLASSES)]
    return F.array(*[F.struct(key.alias("key"), F.lit(less).alias("shorter")) for key, less in own + replaced + shorter])


def _blocks(words: DataFrame) -> DataFrame:
    """``(key, at, n_blocks, tally, letters, ns)``: words packed by their tally of classes.

    ``letters`` has a byte per letter (all lie below U+0100), word after word; ``ns`` their
    counts. A block's words are as long as each other; its size is bounded in letters."""
    tally = _tally(F.col("word"))
    placed = positions(words.select("word", F.col("n").alias("count"), _key(tally).alias("key"), tally.alias("tally")),
                       ["key"], ["word"], "spelling-words")
    size = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.expr(f"{CELLS} div length(word)"))).cast("long")
    member = F.struct("pos", "word", "count")
    packed = placed.withColumn("size", size).groupBy("key", F.expr("pos div size").alias("at")).agg(
        F.expr("first(n + size - 1) div first(size)").alias("n_blocks"), F.first("tally").alias("tally"),
        F.sort_array(F.collect_list(member)).alias("members"))
    return packed.select("key", "at", "n_blocks", "tally",
                         F.encode(F.array_join("members.word", ""), "ISO-8859-1").alias("letters"),
                         F.col("members.count").alias("ns"))


def _near(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether words ``a[i]`` and ``b[j]`` are one edit apart; ``b``'s are as long or one letter longer."""
    x, y = a[i], b[j]
    size = a.shape[1]
    if b.shape[1] == size:
        return (x != y).sum(axis=1) == 1
    head = np.logical_and.accumulate(x == y[:, :size], axis=1).sum(axis=1)
    tail = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return head + tail >= size


def _counts(letters: np.ndarray, slot: np.ndarray, width: int) -> np.ndarray:
    rows = len(letters)
    cells = slot[letters] + np.arange(rows)[:, None] * width
    return np.bincount(cells.ravel(), minlength=rows * width).reshape(rows, width)


def _near_pairs(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of words one edit apart; each pair once if both are the ``same`` block."""
    used = np.union1d(np.unique(a), np.unique(b))
    slot = np.zeros(256, dtype=np.int64)
    slot[used] = np.arange(len(used))
    exact = np.float32 if b.shape[1] ** 2 * 4 < EXACT_FLOAT32 else np.float64
    x, y = _counts(a, slot, len(used)).astype(exact), _counts(b, slot, len(used)).astype(exact)
    # 2ab - aa - bb, minus the squared distance, as one product.
    left = np.hstack([2 * x, -(x * x).sum(axis=1, keepdims=True), np.ones((len(x), 1), exact)])
    right = np.hstack([y, np.ones((len(y), 1), exact), -(y * y).sum(axis=1, keepdims=True)])
    i, j = np.divmod(np.flatnonzero(left @ right.T >= -2), len(y))
    if same:
        i, j = i[i < j], j[i < j]
    near = np.concatenate([_near(a, b, i[k:k + BLOCK], j[k:k + BLOCK]) for k in range(0, len(i), BLOCK)] or [i > j])
    return i[near], j[near]


def near_pairs(words: DataFrame) -> DataFrame:
    """``(a, n_a, b, n_b)``: all words of ``words`` (word, n) one edit apart, each pair once.

    Words are distinct, not null and of letters below U+0100.
    """
    blocks = materialize(_blocks(words), "spelling-blocks")
    sizes = blocks.filter("at = 0").select("key", "n_blocks")
    meets = (blocks.select(F.col("key").alias("own"), F.col("at").alias("own_at"),
                           F.explode(_partners(F.col("tally"))).alias("to"))
             .select("own", "own_at", F.col("to.key").alias("key"), F.col("to.shorter").alias("shorter"))
             .join(sizes, "key")
             .withColumn("last", F.when(F.col("key") == F.col("own"), F.col("own_at")).otherwise(F.col("n_blocks") - 1))
             .select("own", "own_at", "key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))).alias("at")))
    guests = meets.join(blocks.select(F.col("key").alias("own"), F.col("at").alias("own_at"), "tally", "letters", "ns"),
                        ["own", "own_at"])
    length = F.aggregate("tally", F.lit(0), lambda total, k: total + k)
    rows = guests.select("key", "at", F.lit(True).alias("guest"), length.alias("length"), "letters", "ns",
                         ((F.col("key") == F.col("own")) & (F.col("at") == F.col("own_at"))).alias("same"))
    hosts = blocks.select("key", "at", F.lit(False).alias("guest"), length.alias("length"), "letters", "ns",
                          F.lit(False).alias("same"))
    # Partners of one length follow one another, so that several fit into one product.
    dealt = rows.unionByName(hosts).repartition("key", "at").sortWithinPartitions("key", "at", "guest", "same", "length")

    def pairs(source: Iterator[tuple]) -> Iterator[tuple]:
        host, host_ns, held, held_ns = None, None, [], []

        def met(same: bool = False) -> Iterator[tuple]:
            if held:
                others = np.vstack(held)
                for i, j in zip(*(x.tolist() for x in _near_pairs(host, others, same)), strict=True):
                    yield _word(host[i]), host_ns[i], _word(others[j]), held_ns[j]
                held.clear()
                held_ns.clear()

        for _, _, guest, length, letters, ns, same in source:
            block = np.frombuffer(letters, dtype=np.uint8).reshape(-1, length)
            if not guest:
                yield from met()
                host, host_ns = block, ns
                continue
            if same or held and (held[0].shape[1] != length or len(held_ns) + len(ns) > TOGETHER):
                yield from met()
            held.append(block)
            held_ns.extend(ns)
            if same:
                yield from met(same=True)
        yield from met()

    return map_rows(dealt, ["key", "at", "guest", "length", "letters", "ns", "same"], pairs, T.StructType([
        T.StructField("a", T.StringType()), T.StructField("n_a", T.LongType()),
        T.StructField("b", T.StringType()), T.StructField("n_b", T.LongType())]))


def _word(letters: np.ndarray) -> str:
    return letters.tobytes().decode("latin-1")


def _roots(words: DataFrame) -> DataFrame:
    """``words`` with ``root``: the end of the chain of forms from ``word``, by pointer doubling.

    A form occurs ``FORM_RATIO`` times as often as its word, so chains have no circles and
    are as long as the logarithm of the largest count at most.
    """
    jumps = materialize(words.filter("form is not null").select("word", F.col("form").alias("root")), "spelling-forms")
    while True:
        beyond = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = materialize(jumps.join(beyond, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-forms")
        jumps = jumped.drop("moved")
        if jumped.filter("moved").isEmpty():
            break
    return words.join(jumps, "word", "left").withColumn("root", F.coalesce("root", "word"))


def group_variants(counts: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of the words of ``counts`` with ``min_count`` or more.

    ``form`` is the most frequent near word (ties: the smallest), if it occurs ``FORM_RATIO``
    times as often, else null, with ``form_n`` its count; ``root`` is where forms lead to, the
    word itself if it has none. A table without words has no rows.
    """
    words = materialize(counts.filter(F.col("n") >= min_count), "spelling-counts")
    both = F.array(F.struct(F.col("a").alias("word"), (-F.col("n_b")).alias("less"), F.col("b").alias("other")),
                   F.struct(F.col("b").alias("word"), (-F.col("n_a")).alias("less"), F.col("a").alias("other")))
    best = near_pairs(words).select(F.explode(both).alias("x")).groupBy("x.word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct("x.less", "x.other")).alias("best"))
    often = -F.col("best.less") >= FORM_RATIO * F.col("n")
    formed = materialize(words.join(best, "word", "left").select(
        "word", F.when(often, F.col("best.other")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(often, -F.col("best.less")).alias("form_n")),
        "spelling-near")
    return _roots(formed).select("word", "form", "root", "n", "n_near", "form_n")
