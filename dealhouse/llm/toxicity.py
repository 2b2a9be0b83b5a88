"""Toxic span tagging with a linear-chain conditional random field.

Labels are per document, so tokens are labelled at a distance: words and word beginnings
("cues") that stand in toxic documents far more often than chance allows mark their
tokens as toxic there. A two-state chain is fitted to these labelled tokens; its
forward-backward marginals give offending spans. Their sum is the expected number of toxic
tokens; what it has beyond that of a text of the same length without cues gives the document
score, through a calibration on the same rows. So all documents without cues score alike.

Most tokens carry no cue. They share one transition matrix, so forward and backward
passes step over a run of them with a power of that matrix: the result is that of the
whole chain, at the cost of the cue tokens alone.

Fitting uses at most ``TRAIN_ROWS`` labelled texts, chosen by hash, whatever number of rows
repeats an id or a text; every document is scored whole.
"""
from __future__ import annotations

import logging
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealhouse.llm.common import bound_batches, map_rows, materialize

LOG = logging.getLogger(__name__)

TRAIN_ROWS = 20_000   # labelled texts that the model is fitted on, at most
GAP = 1e-3            # log likelihood that the fitted chain may lack of the optimum, over the whole sample
MAX_CUES = 4096       # cues in a model, at most: the strongest
MIN_EVIDENCE = 4.0    # -log10 of the chance of a cue's count in toxic documents
MIN_TOXIC_DOCS = 3
PREFIXES = range(4, 9)
RARE = -6.0           # log odds of state 1 without a cue where fitting begins; where it ends does not depend on it
EDGES = (1.5, 2.5, 4.0, 6.0)  # log odds that part the cue classes
CLASSES = 2 * (len(EDGES) + 1)
KNOWN_WORDS = 100_000  # words whose class a task remembers
CELLS = 100_000        # cells of the tables of cues that are worked on at once
THRESHOLD = 0.3
FLUSH = 100_000       # features counted in a task before they are passed on
STRIP = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
TOKEN = re.compile(r"\S+")


def tokens(text: str | None) -> list[str]:
    return [w.strip(STRIP) for w in (text or "").lower().split()]


def features(word: str) -> list[str]:
    """A word and its beginnings, marked apart."""
    return ["=" + word, *("^" + word[:k] for k in PREFIXES if len(word) > k)] if word else []


# --- labelled tokens ------------------------------------------------------------------

def text_key(text: str | None) -> bytes:
    """Equal for texts with equal tokens."""
    return xxhash.xxh3_128_digest(" ".join(tokens(text)).encode("utf-8", "surrogatepass"))


def training_sample(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``(sample_id, toxic, text)`` of the labelled rows to fit on, exact copies (equal tokens) once each.

    Rows whose crc32(doc_id) mod 4 is 2 are held out. A document labelled both ways is toxic. Ids are taken by
    hash, then texts by hash, so an id with any number of rows and texts brings no more than ``train_rows`` rows.
    """
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
             .withColumn("at", F.xxhash64("doc_id")))
    n = known.count()
    share = min(1.0, 1.2 * train_rows / max(n, 1))
    ids = known.filter(F.pmod("at", F.lit(1_000_000)) < int(share * 1_000_000)).orderBy("at").limit(train_rows)
    ids = materialize(ids.select(F.col("doc_id").alias("sample_id"), "toxic"), "toxic-ids")
    labelled = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("sample_id"))

    def keys(source: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, toxic, text in source:
            yield doc_id, toxic, text_key(text)

    def texts(source: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, toxic, text in source:
            yield doc_id, toxic, text_key(text), text

    columns = ["sample_id", "toxic", "key"]
    fields = [ids.schema["sample_id"], ids.schema["toxic"], T.StructField("key", T.BinaryType())]
    chosen = materialize(map_rows(labelled, ["sample_id", "toxic", "text"], keys, T.StructType(fields))
                         .groupBy("key", "toxic").agg(F.min("sample_id").alias("sample_id"))
                         .orderBy(F.xxhash64("key"), "key", "toxic").limit(train_rows).select(columns), "toxic-keys")
    with_text = map_rows(labelled, ["sample_id", "toxic", "text"], texts,
                         T.StructType([*fields, T.StructField("text", T.StringType())]))
    # Repeats of a chosen text are one row a task before they meet
    return materialize(with_text.join(F.broadcast(chosen), columns).groupBy(columns).agg(F.max("text").alias("text"))
                       .select("sample_id", "toxic", "text"), "toxic-sample")


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def learn_cues(sample: DataFrame) -> dict[str, float]:
    """The strongest cues and their log odds, from document counts over the sample."""
    def count(source: Iterator[tuple]) -> Iterator[tuple]:
        seen: tuple[Counter, Counter] = Counter(), Counter()
        for toxic, text in source:
            found = {f for w in set(tokens(text)) for f in features(w)}
            seen[toxic].update(found)
            if len(seen[0]) + len(seen[1]) > FLUSH:
                yield from _flush(seen)
        yield from _flush(seen)

    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_clean:
        return {}
    counts = map_rows(sample, ["toxic", "text"], count, T.StructType([
        T.StructField("cue", T.StringType()), T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))
    sums = counts.groupBy("cue").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    share, other = F.col("a") / (F.col("a") + F.col("b")), F.lit(n_toxic / (n_toxic + n_clean))
    # Chernoff bound of the binomial tail: the chance of so many toxic documents among those with the cue
    spread = share * F.log(share / other) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - other))).otherwise(0)
    evidence = F.when(share > other, (F.col("a") + F.col("b")) * spread / math.log(10)).otherwise(0)
    odds = F.log((F.col("a") + 0.5) / (n_toxic + 1) / ((F.col("b") + 0.5) / (n_clean + 1)))
    best = (sums.filter(F.col("a") >= MIN_TOXIC_DOCS).select("cue", evidence.alias("evidence"), odds.alias("odds"))
            .filter((F.col("evidence") >= MIN_EVIDENCE) & (F.col("odds") > EDGES[0] / 2))
            .orderBy(F.desc("evidence"), "cue").limit(MAX_CUES))
    return {r["cue"]: r["odds"] for r in best.select("cue", "odds").collect()}


def _flush(seen: tuple[Counter, Counter]) -> Iterator[tuple]:
    clean, toxic = seen
    for cue in clean.keys() | toxic.keys():
        yield cue, toxic[cue], clean[cue]
    clean.clear()
    toxic.clear()


def class_of(word: str, cues: dict[str, float]) -> int:
    """The word's cue class; 0 without a cue. Whole words and beginnings have classes of their own."""
    best = 0
    for f in features(word):
        odds = cues.get(f)
        if odds is not None:
            step = sum(odds >= e for e in EDGES)
            best = max(best, 1 + 2 * step + (f[0] == "="))
    return best


def tagger(cues: dict[str, float]) -> Callable[[list[str]], list[tuple[int, int]]]:
    """A function from tokens to ``(position, class)`` of those with a cue."""
    known: dict[str, int] = {}

    def tag(words: list[str]) -> list[tuple[int, int]]:
        if len(known) >= KNOWN_WORDS:
            known.clear()
        out = []
        for at, word in enumerate(words):
            c = known.get(word)
            if c is None:
                c = known[word] = class_of(word, cues)
            if c:
                out.append((at, c))
        return out

    return tag


# --- the chain ------------------------------------------------------------------------
# Parameters: start in state 1; moves 0->1, 1->0, 1->1 (0->0 is 0); a weight of state 1 for each class.

def _steps(theta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start vector, transition matrix, and the matrices of one token of each class (0: none)."""
    start = np.exp(np.array([0.0, theta[0]]))
    move = np.exp(np.array([[0.0, theta[1]], [theta[2], theta[3]]]))
    weights = np.exp(np.concatenate(([0.0], theta[4:])))
    each = move[None] * np.stack([np.ones_like(weights), weights], axis=-1)[:, None, :]
    return start, move, each


class _Run:
    """Powers of the matrix of a token without cue, less their growth."""

    def __init__(self, m: np.ndarray) -> None:
        (a, b), (c, d) = m
        half, root = (a + d) / 2, math.sqrt(((a - d) / 2) ** 2 + b * c)
        self.top, low = half + root, half - root
        self.log_top, self.ratio = math.log(self.top), low / self.top
        self.p = (m - low * np.eye(2)) / (self.top - low)
        self.q = np.eye(2) - self.p

    def power(self, n: np.ndarray | int) -> np.ndarray:
        if isinstance(n, int):
            return self.p + self.ratio ** n * self.q
        return self.p + (self.ratio ** n)[:, None, None] * self.q


def _forward(theta: np.ndarray, n: np.ndarray, gaps: np.ndarray,
             classes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Log Z by document, the forward vectors before each run (the last: after the last cue), tokens left after it.

    ``n`` tokens, then per cue the run before it and its class (0: no more)."""
    start, _, each = _steps(theta)
    run = _Run(each[0])
    vectors = [np.repeat(start[None], len(n), axis=0)]
    log_z = np.zeros(len(n))
    left = n.astype(float).copy()
    for k in range(gaps.shape[1]):
        alpha, live = vectors[-1].copy(), classes[:, k] > 0
        stepped = np.einsum("di,dij->dj", alpha[live], run.power(gaps[live, k]))
        stepped = np.einsum("di,dij->dj", stepped, each[classes[live, k]])
        size = stepped.sum(axis=1)
        alpha[live] = stepped / size[:, None]
        log_z[live] += np.log(size) + gaps[live, k] * run.log_top
        left[live] -= gaps[live, k] + 1
        vectors.append(alpha)
    ends = np.einsum("di,dij->dj", vectors[-1], run.power(left))
    return log_z + left * run.log_top + np.log(ends.sum(axis=1)), vectors, left


def log_partition(theta: np.ndarray, n: np.ndarray, gaps: np.ndarray, classes: np.ndarray) -> float:
    """Sum of log Z over documents, by the forward pass."""
    return float(_forward(theta, n, gaps, classes)[0].sum())


def expected_counts(theta: np.ndarray, n: np.ndarray, gaps: np.ndarray, classes: np.ndarray) -> tuple[float, np.ndarray]:
    """Sum of log Z over documents and, by forward and backward passes, how often each parameter acts on a path:
    the gradient of that sum."""
    start, move, each = _steps(theta)
    run = _Run(each[0])
    log_z, vectors, left = _forward(theta, n, gaps, classes)
    moves, held = np.zeros((2, 2)), np.zeros(1 + CLASSES)

    def through(alpha: np.ndarray, size: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Adds the moves within runs of ``size`` tokens; the backward vectors before them."""
        # alpha M^j and M^(size-1-j) end are sums of a fixed part and one that shrinks by ratio^j: sum over j at once
        r = run.ratio
        whole, to_p, to_q = r ** size, alpha @ run.p, alpha @ run.q
        p_end, q_end = end @ run.p.T, end @ run.q.T
        back = p_end + whole[:, None] * q_end
        z = (alpha * back).sum(axis=1)
        flat, edge = (size / z)[:, None], ((1 - whole) / (1 - r) / z)[:, None]
        both = (np.where(size > 0, size * r ** np.maximum(size - 1, 0), 0.0) / z)[:, None]
        inside = (to_p * flat + to_q * edge).T @ p_end + (to_p * edge + to_q * both).T @ q_end
        moves[:] += inside * move / run.top
        return back / back.sum(axis=1)[:, None]

    beta = through(vectors[-1], left, np.ones((len(n), 2)))
    for k in reversed(range(gaps.shape[1])):
        live = classes[:, k] > 0
        alpha, c, size = vectors[k][live], classes[live, k], gaps[live, k].astype(float)
        step = np.einsum("di,dij->dj", alpha, run.power(size))[:, :, None] * each[c] * beta[live][:, None, :]
        step /= step.sum(axis=(1, 2))[:, None, None]
        moves += step.sum(axis=0)
        held += np.bincount(c, weights=step[:, :, 1].sum(axis=1), minlength=len(held))
        beta[live] = through(alpha, size, np.einsum("dij,dj->di", each[c], beta[live]))
    first = start * beta
    begun = float((first[:, 1] / first.sum(axis=1)).sum())
    return float(log_z.sum()), np.array([begun, moves[0, 1], moves[1, 0], moves[1, 1], *held[1:]])


def _run_marginals(run: _Run, alpha: np.ndarray, n: int, end: np.ndarray) -> tuple[float, list[tuple[int, float]]]:
    """Sum of the chances of state 1 over ``n`` tokens without cue, and ``(place, chance)`` of those of a half or more.

    ``alpha`` is the forward vector before the run, ``end`` the backward vector at its last token.
    """
    r = run.ratio
    to_p, to_q, p_end, q_end = alpha @ run.p, alpha @ run.q, run.p @ end, run.q @ end
    whole = r ** n
    z = float(to_p @ end + whole * (to_q @ end))
    # Token j of 1 to n: (to_p + r^j to_q)[1] (p_end + r^(n-j) q_end)[1] / z
    flat = float(to_p[1] * p_end[1] + whole * to_q[1] * q_end[1]) / z
    after, before = float(to_q[1] * p_end[1]) / z, float(to_p[1] * q_end[1]) / z
    powers = (1 - whole) / (1 - r)  # r^0 to r^(n-1)
    total = n * flat + (after * r + before) * powers
    sure: list[tuple[int, float]] = []
    if flat + abs(after * r) + abs(before) >= 0.5:  # no chance is above
        j = np.arange(1, n + 1)
        chances = flat + after * r ** j + before * r ** (n - j)
        sure = [(int(k), float(chances[k])) for k in np.flatnonzero(chances >= 0.5)]
    return min(max(total, 0.0), float(n)), sure


def chain_marginals(theta: np.ndarray, n: int, hits: list[tuple[int, int]],
                    runs: bool = True) -> tuple[list[float], float, list[tuple[int, float]]]:
    """By forward and backward passes: the chance of state 1 at each token with a cue; with ``runs``, the sum of the
    chances of the other tokens, and ``(position, chance)`` of those of a half or more."""
    start, _, each = _steps(theta)
    run = _Run(each[0])
    forward, alpha, last = [], start, -1
    for at, c in hits:
        alpha = alpha @ run.power(at - last - 1) @ each[c]
        alpha = alpha / alpha.sum()
        forward.append(alpha)
        last = at
    out, beta, after = [], np.ones(2), n
    rest, sure = 0.0, []
    for (at, c), alpha in zip([*reversed(hits), (-1, 0)], [*reversed(forward), start], strict=True):
        if runs and after - at > 1:
            total, found = _run_marginals(run, alpha, after - at - 1, beta)
            rest += total
            sure += [(at + 1 + k, p) for k, p in found]
        if at < 0:
            break
        here = run.power(after - at - 1) @ beta
        both = alpha * here
        out.append(float(both[1] / both.sum()))
        beta = each[c] @ (here / here.sum())
        after = at
    return out[::-1], rest, sure


def marginals(theta: np.ndarray, n: int, hits: list[tuple[int, int]]) -> list[float]:
    """The chance of state 1 at each token with a cue."""
    return chain_marginals(theta, n, hits, runs=False)[0]


def tagged(theta: np.ndarray, n: int, hits: list[tuple[int, int]]) -> tuple[float, dict[int, float]]:
    """Expected number of tokens in state 1, of all ``n``, and the chances of those of a half or more by position."""
    chances, rest, sure = chain_marginals(theta, n, hits)
    sure += [(at, p) for (at, _), p in zip(hits, chances, strict=True) if p >= 0.5]
    return sum(chances) + rest, dict(sure)


def label_counts(n: int, hits: list[tuple[int, int]], toxic: int) -> np.ndarray:
    """How often each parameter acts on the labelled path: cues of toxic documents are in state 1."""
    counts = np.zeros(4 + CLASSES)
    if toxic:
        before = -2
        for at, c in hits:
            counts[3 if at == before + 1 else 1] += 1
            counts[3 + c] += 1
            if before >= 0 and at > before + 1:
                counts[2] += 1
            before = at
        if before >= 0 and before < n - 1:
            counts[2] += 1
    return counts


def fit_chain(sequences: DataFrame, ridge: float = 1.0, gap: float = GAP) -> np.ndarray:
    """Maximum likelihood with a ridge by quasi-Newton steps; each needs one pass over ``sequences``, which returns
    the likelihood and its gradient, so the driver adds vectors of fixed size.

    The loss is convex and the ridge bounds its curvature from below, so a gradient g proves that at most
    ``|g|^2 / (2 ridge)`` is lacking: steps go on until that is ``gap`` or less. Where rounding ends the descent
    before, a warning tells what may be lacking.
    """
    def total(fn: Callable[[list], np.ndarray], width: int) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(width)
            for batch in batches:
                rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
                if rows:
                    sums += fn(rows)
            yield pa.RecordBatch.from_pydict({"sums": [sums.tolist()]})

        parts = bound_batches(sequences).mapInArrow(run, "sums array<double>")
        row = parts.agg(*[F.sum(F.get("sums", F.lit(i))) for i in range(width)]).first()
        return np.array([x or 0.0 for x in row])

    size = 4 + CLASSES

    def labelled(rows: list) -> np.ndarray:
        on_path = sum(label_counts(n, list(zip(at, c, strict=True)), t) for n, at, c, t in rows)
        at_all = np.bincount(np.fromiter(chain.from_iterable(r[2] for r in rows), dtype=np.int64), minlength=1 + CLASSES)
        return np.concatenate((on_path, at_all[1:]))

    counted = total(labelled, size + CLASSES)
    observed, tokens_of_class = counted[:size], counted[size:]

    def loss(theta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def fn(rows: list) -> np.ndarray:
            out = np.zeros(1 + size)
            for part in _alike(rows):
                log_z, counts = expected_counts(theta, *_padded(part))
                out += [log_z, *counts]
            return out

        sums = total(fn, 1 + size)
        return (float(sums[0] - observed @ theta + ridge / 2 * theta @ theta),
                sums[1:] - observed + ridge * theta, sums[1:])

    # Begins where each token's chance of state 1 is its class's share of toxic labels
    theta = np.zeros(size)
    theta[:4] = RARE
    theta[4:] = np.log((observed[4:] + 0.5) / (tokens_of_class - observed[4:] + 0.5)) - RARE
    theta[4:][tokens_of_class == 0] = 0.0
    theta[2] = 0.0
    value, slope, counts = loss(theta)
    inverse = np.diag(1 / (counts + ridge))  # of counts that are rare and apart; steps mend it
    while slope @ slope > 2 * ridge * gap:
        way = -inverse @ slope
        way *= min(1.0, 4.0 / np.abs(way).max())
        length = 1.0
        while True:
            ahead = theta + length * way
            new_value, new_slope, _ = loss(ahead)
            if new_value <= value + 1e-4 * length * float(slope @ way):
                break
            length /= 3
            if length < 1e-6:
                LOG.warning("toxicity chain: the log likelihood may lack up to %.3g", slope @ slope / (2 * ridge))
                return theta
        moved, turned = ahead - theta, new_slope - slope
        along = float(moved @ turned)
        if along > 0:
            mend = np.eye(size) - np.outer(moved, turned) / along
            inverse = mend @ inverse @ mend.T + np.outer(moved, moved) / along
        theta, value, slope = ahead, new_value, new_slope
    return theta


def _alike(rows: list) -> Iterator[list]:
    """Rows in groups of like numbers of cues, none of which pads to more than ``CELLS`` cells."""
    part: list = []
    for row in sorted(rows, key=lambda r: len(r[1])):
        if part and (len(part) + 1) * len(row[1]) > CELLS:
            yield part
            part = []
        part.append(row)
    if part:
        yield part


def _padded(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(r[1]) for r in rows])
    filled = np.arange(sizes.max()) < sizes[:, None]
    places, classes = np.zeros(filled.shape, dtype=np.int64), np.zeros(filled.shape, dtype=np.int64)
    places[filled] = np.fromiter(chain.from_iterable(r[1] for r in rows), dtype=np.int64)
    classes[filled] = np.fromiter(chain.from_iterable(r[2] for r in rows), dtype=np.int64)
    gaps = np.where(filled, np.diff(places, axis=1, prepend=-1) - 1, 0)
    return np.array([r[0] for r in rows]), gaps, classes


# --- document scores ------------------------------------------------------------------

def _terms(excess: float, n: int) -> tuple[float, ...]:
    """What the calibration sees: toxic tokens beyond those of a text without cues, and how many in a thousand."""
    return 1.0, math.log1p(4 * excess), math.log1p(1000 * excess / (n + 5)), float(excess < 0.05)


def excess_tagger(theta: np.ndarray) -> Callable[[int, list[tuple[int, int]]], tuple[float, dict[int, float]]]:
    """A function from a text's length and cues to the expected toxic tokens beyond those of a text of that length
    without cues (0 at least, and without cues), and the chances of the likely ones by position."""
    @lru_cache(maxsize=KNOWN_WORDS)
    def plain(n: int) -> float:
        return tagged(theta, n, [])[0]

    def excess(n: int, hits: list[tuple[int, int]]) -> tuple[float, dict[int, float]]:
        if not hits:
            return 0.0, {}
        total, sure = tagged(theta, n, hits)
        return max(0.0, total - plain(n)), sure

    return excess


@dataclass
class ToxicityModel:
    cues: dict[str, float] = field(default_factory=dict)
    theta: np.ndarray = field(default_factory=lambda: np.zeros(4 + CLASSES))
    weights: tuple[float, ...] | None = None  # None: nothing was learned, every score is 0

    def reader(self) -> Callable[[str | None], tuple[int, float, dict[int, float]]]:
        """A function from a text to its number of tokens, the excess of toxic ones, and the likely ones by position."""
        tag, excess = tagger(self.cues), excess_tagger(self.theta)

        def read(text: str | None) -> tuple[int, float, dict[int, float]]:
            words = tokens(text)
            return len(words), *excess(len(words), tag(words))

        return read

    def score(self, excess: float, n: int) -> float:
        if self.weights is None:
            return 0.0
        x = sum(w * t for w, t in zip(self.weights, _terms(excess, n), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Cues, chain and calibration from the labelled rows of ``docs`` that are not held out.

    Without toxic and clean labelled rows the model is empty and scores 0.
    """
    sample = training_sample(docs, labels, train_rows)
    cues = learn_cues(sample)
    if not cues:
        return ToxicityModel()

    def compact(source: Iterator[tuple]) -> Iterator[tuple]:
        tag = tagger(cues)
        for toxic, text in source:
            words = tokens(text)
            found = tag(words)
            yield len(words), [at for at, _ in found], [c for _, c in found], toxic

    ints = T.ArrayType(T.IntegerType())
    sequences = materialize(map_rows(sample, ["toxic", "text"], compact, T.StructType([
        T.StructField("n", T.IntegerType()), T.StructField("at", ints), T.StructField("classes", ints),
        T.StructField("toxic", T.IntegerType())])), "toxic-sequences")
    theta = fit_chain(sequences)

    def expect(source: Iterator[tuple]) -> Iterator[tuple]:
        excess = excess_tagger(theta)
        for n, at, classes, toxic in source:
            total, _ = excess(n, list(zip(at, classes, strict=True)))
            yield min(int(8 * math.log2(1 + total)), 127), int(2 * math.log2(1 + n)), toxic, total, n

    binned = map_rows(sequences, ["n", "at", "classes", "toxic"], expect, T.StructType([
        T.StructField("e", T.IntegerType()), T.StructField("m", T.IntegerType()),
        T.StructField("toxic", T.IntegerType()), T.StructField("total", T.DoubleType()),
        T.StructField("n", T.IntegerType())]))
    # At most 128 x 64 x 2 rows, whatever the sample
    bins = binned.groupBy("e", "m", "toxic").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("total").alias("total"), F.avg("n").alias("n")).collect()
    return ToxicityModel(cues, theta, _logistic(
        np.array([_terms(b["total"], b["n"]) for b in bins]), np.array([b["toxic"] for b in bins], dtype=float),
        np.array([b["rows"] for b in bins], dtype=float)))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 0.5) -> tuple[float, ...]:
    beta = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (w * (p - y)) + ridge * beta
        curve = (x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        beta = beta - np.linalg.solve(curve, slope)
    return tuple(beta.tolist())


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``(doc_id, score, spans)`` per row of ``docs``; only the text decides.

    ``spans`` are ``(start, end, marginal)`` in code points of tokens that are toxic with a
    chance of a half or more. Null and empty texts have no tokens and get the score of a
    document without cues.
    """
    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        read = model.reader()
        for doc_id, text in source:
            n, excess, sure = read(text)
            spans = [(m.start(), m.end(), sure[i]) for i, m in enumerate(TOKEN.finditer(text)) if i in sure] if sure else []
            yield doc_id, model.score(excess, n), [{"start": s, "end": e, "chance": p} for s, e, p in spans]

    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                         T.StructField("chance", T.DoubleType())])
    return map_rows(docs, ["doc_id", "text"], rows, T.StructType([
        docs.schema["doc_id"], T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))]))


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score is under ``threshold``."""
    text_at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = model.reader()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                mask = []
                for text in part.column(text_at).to_pylist():
                    n, excess, _ = read(text)
                    mask.append(model.score(excess, n) < threshold)
                yield part.filter(pa.array(mask, type=pa.bool_()))

    return bound_batches(docs).mapInArrow(keep, docs.schema)
