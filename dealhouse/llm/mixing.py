"""Soft-membership mixing: document rates whose expected domain totals match target weights.

A labelled table trains a naive Bayes classifier on the presence of telling words; its
posteriors say how far each document belongs to each domain. Rates r (how often a document is
to be used) are fitted by projected-gradient least squares: among rates of ``at_least`` or
more, those least changed from 1, in squares weighted by tokens, whose expected tokens of each
domain, sum of r * tokens * posterior, match the targets. Projection is lazy: gradients add up
to one vector with a number per domain, and a rate is projected when it is looked at. So the
rate is a short expression over the document's own posteriors: no join, nothing per document
is kept. A step is one distributed aggregate of a few numbers; it is scaled by the curvature of
the rates off their bound, which the same aggregate returns, so a handful of steps does, and
steps go on until the targets are met or come no nearer.

DataFrame and SQL functions only.
"""
from __future__ import annotations

import logging
import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealhouse.llm.common import materialize

LOG = logging.getLogger(__name__)
TRAIN_ROWS = 20_000  # labelled documents that the classifier is trained on, about
VOCABULARY = 96      # telling words
TEMPER = 0.25        # naive Bayes counts kindred words as independent; this tempers its certainty
TOLERANCE = 1e-4     # greatest gap, as a share of a domain's target, at which descent ends
RIDGE, SOFT_RIDGE = 1e-9, 1e-2  # what holds the gradient sum back, of the tokens; soft: targets out of reach
STALLED = 12         # steps in a row without a tenth off the gap: the targets are out of reach
WORD_BREAK, WORD_BREAK_CHARS = "[\\x20\\x09-\\x0D]+", " \t\n\u000b\u000c\r"
# Target weights of the registered query and the pipeline.
WEIGHTS = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}


def words_of(text: Column) -> Column:
    bare = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD_BREAK_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WORD_BREAK))


@dataclass(frozen=True)
class Classifier:
    """Bernoulli naive Bayes: log odds of each domain, and what each telling word adds to them."""

    domains: tuple[str, ...]
    base: tuple[float, ...]
    words: tuple[tuple[str, tuple[float, ...]], ...]

    def memberships(self, words: Column) -> Column:
        """Posteriors per domain, as an array, from the words of a document."""
        zero = F.array(*[F.lit(b) for b in self.base])
        if not self.words:
            odds = zero
        else:
            weight = F.map_from_arrays(
                F.array(*[F.lit(w) for w, _ in self.words]),
                F.array(*[F.array(*[F.lit(x) for x in d]) for _, d in self.words]))
            present = F.array_intersect(words, F.array(*[F.lit(w) for w, _ in self.words]))
            odds = F.aggregate(present, zero, lambda total, w: F.zip_with(total, weight[w], lambda a, b: a + b))
        raised = F.transform(F.array(odds), lambda o: F.transform(
            o, lambda x: F.exp(F.lit(TEMPER) * (x - F.array_max(o)))))[0]
        return F.transform(F.array(raised), lambda r: F.transform(
            r, lambda x: x / F.aggregate(r, F.lit(0.0), lambda a, b: a + b)))[0]


def train(labelled: DataFrame, label: str, train_rows: int = TRAIN_ROWS, vocabulary: int = VOCABULARY) -> Classifier:
    """Classifier from rows of (doc_id, text, ``label``); rows without a label or id are passed over.

    Labelled rows are chosen by a hash of doc_id, so that about ``train_rows`` are used.
    """
    known = labelled.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy(label).agg(F.count(F.lit(1))).collect()}  # a row per domain
    total = sum(sizes.values())
    if not total:
        return Classifier((), (), ())
    share = min(1.0, train_rows / total)
    sample = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < math.ceil(share * 1_000_000))
    seen = sample.select(F.col(label).alias("domain"), F.array_distinct(words_of(F.col("text"))).alias("words"))
    domains = sorted(sizes)
    sampled = {r[0]: r[1] for r in seen.groupBy("domain").agg(F.count(F.lit(1))).collect()}
    rows = seen.select("domain", F.explode("words").alias("word")).groupBy("word").agg(
        *[F.sum((F.col("domain") == d).cast("long")).alias(f"d{i}") for i, d in enumerate(domains)])
    rates = [(F.col(f"d{i}") + 0.5) / F.lit(sampled.get(d, 0) + 1.0) for i, d in enumerate(domains)]
    spread = F.greatest(*rates) - F.least(*rates) if len(rates) > 1 else F.lit(0.0)
    telling = rows.withColumn("spread", spread).orderBy(F.desc("spread"), "word").limit(vocabulary).collect()
    base = [math.log(sizes[d] / total) for d in domains]
    words = []
    for row in telling:
        adds = []
        for i, d in enumerate(domains):
            p = (row[f"d{i}"] + 0.5) / (sampled.get(d, 0) + 1.0)
            base[i] += math.log1p(-p) if p < 1 else 0.0
            adds.append(math.log(p) - (math.log1p(-p) if p < 1 else 0.0))
        words.append((row["word"], tuple(adds)))
    return Classifier(tuple(domains), tuple(base), tuple(words))


@dataclass(frozen=True)
class Rates:
    """Rates as a function of posteriors, and what they come to in each domain.

    A rate is ``base`` less the posteriors along ``pull``, but no less than ``at_least``. ``gaps``
    are expected tokens less target, as a share of the target; ``reached`` says whether all lie
    within the tolerance asked for.
    """

    at_least: float = 0.0
    base: float = 1.0
    pull: tuple[float, ...] = ()
    expected: tuple[float, ...] = ()
    targets: tuple[float, ...] = ()
    reached: bool = True

    @property
    def gaps(self) -> tuple[float, ...]:
        return tuple((e - t) / t if t else float(e > 0) for e, t in zip(self.expected, self.targets, strict=True))

    def of(self, member: Column) -> Column:
        return F.greatest(F.lit(self.at_least), self.unbounded(member))

    def unbounded(self, member: Column) -> Column:
        pulls = [F.get(member, F.lit(i)) * F.lit(float(x)) for i, x in enumerate(self.pull) if x]
        return reduce(lambda total, x: total - x, pulls, F.lit(float(self.base)))


def _solve(a: list[list[float]], b: list[float]) -> list[float]:
    """The solution of a small symmetric positive definite system."""
    n = len(b)
    rows = [[*row, x] for row, x in zip(a, b, strict=True)]
    for i in range(n):
        at = max(range(i, n), key=lambda r: abs(rows[r][i]))
        rows[i], rows[at] = rows[at], rows[i]
        for r in range(i + 1, n):
            f = rows[r][i] / rows[i][i]
            rows[r] = [x - f * y for x, y in zip(rows[r], rows[i], strict=True)]
    out = [0.0] * n
    for i in reversed(range(n)):
        out[i] = (rows[i][n] - sum(rows[i][j] * out[j] for j in range(i + 1, n))) / rows[i][i]
    return out


@dataclass(frozen=True)
class _Point:
    """What one aggregate says of a gradient sum: loss, expected tokens, curvature."""

    loss: float
    expected: list[float]
    curvature: list[list[float]]


def _look(members: DataFrame, rates: Rates, k: int) -> _Point:
    """Half the squared rates beyond the bound (linear below it), weighted by tokens, and its derivatives."""
    free, rate, low = F.col("free"), F.col("rate"), F.lit(rates.at_least)
    member = [F.get("member", F.lit(i)) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    part = F.when(free > low, free * free).otherwise(2 * low * free - low * low) / 2
    off = F.when(free > low, F.col("tokens")).otherwise(F.lit(0))
    row = members.select("tokens", "member", rates.unbounded(F.col("member")).alias("free"),
                         rates.of(F.col("member")).alias("rate")).agg(
        F.sum(F.col("tokens") * part).alias("loss"),
        *[F.sum(F.col("tokens") * rate * m).alias(f"e{i}") for i, m in enumerate(member)],
        *[F.sum(off * member[i] * member[j]).alias(f"h{i}_{j}") for i, j in pairs],
        *[F.sum(off * m).alias(f"m{i}") for i, m in enumerate(member)], F.sum(off).alias("off")).first()
    def number(name: str) -> float:
        return row[name] or 0.0

    curvature = [[number(f"h{max(i, j)}_{min(i, j)}") for j in range(k)] + [number(f"m{i}")] for i in range(k)]
    return _Point(number("loss"), [number(f"e{i}") for i in range(k)],
                  [*curvature, [*(number(f"m{i}") for i in range(k)), number("off")]])


def fit_rates(members: DataFrame, weights: list[float], at_least: float = 0.0,
              tolerance: float = TOLERANCE) -> Rates:
    """Rates over ``members`` (tokens, member) that meet ``weights``.

    With ``at_least`` below 1 the token total stays what it is. From 1 on nothing may be left
    out, so the total is free and the shares alone have to match. A domain without a token has no
    target; its weight goes to the others. Targets that no rates reach are missed by
    least squares, with rates held near 1 by ``SOFT_RIDGE``: ``reached`` is false, ``gaps`` tell by
    how much, and a warning is logged.
    """
    k = len(weights)
    start = Rates(at_least=float(at_least), base=1.0, pull=(0.0,) * k)
    first = _look(members, replace(start, at_least=min(start.at_least, 1.0)), k)
    total = sum(first.expected)
    if not total:
        return replace(start, expected=(0.0,) * k, targets=(0.0,) * k)
    held = [w if e > 0 else 0.0 for w, e in zip(weights, first.expected, strict=True)]
    share = [w / (sum(held) or 1.0) for w in held]
    found = _descend(members, share, start, total, RIDGE * total, tolerance)
    if not found.reached:
        found = replace(_descend(members, share, start, total, SOFT_RIDGE * total, tolerance), reached=False)
        LOG.warning("mixing targets are out of reach; gaps by domain: %s", [round(g, 4) for g in found.gaps])
    return found


def _descend(members: DataFrame, share: list[float], start: Rates, total: float, ridge: float,
             tolerance: float) -> Rates:
    k, fixed = len(share), start.at_least < 1
    # With a free total, what counts of a posterior is what it has beyond the share.
    less = [0.0] * k if fixed else share
    goal = [s * total if fixed else 0.0 for s in share]

    def at(pull: list[float]) -> Rates:
        return replace(start, base=1.0 + sum(s * x for s, x in zip(less, pull, strict=True)), pull=tuple(pull))

    def seen(pull: list[float]) -> tuple:
        """Loss, gradient, curvature and rates at a gradient sum."""
        p = _look(members, at(pull), k)
        mass = sum(p.expected)
        gap = [e - s * mass - g for e, s, g in zip(p.expected, less, goal, strict=True)]
        slope = [ridge * x - d for x, d in zip(pull, gap, strict=True)]
        m, n = p.curvature[k], p.curvature[k][k]
        bend = [[p.curvature[i][j] - less[i] * m[j] - less[j] * m[i] + less[i] * less[j] * n + (ridge if i == j else 0.0)
                 for j in range(k)] for i in range(k)]
        loss = p.loss + sum(x * g for x, g in zip(pull, goal, strict=True)) + ridge / 2 * sum(x * x for x in pull)
        aim = [s * total if fixed else s * mass for s in share]
        rates = replace(at(pull), expected=tuple(p.expected), targets=tuple(aim))
        rates = replace(rates, reached=all(abs(g) <= tolerance for g in rates.gaps))
        return loss, slope, bend, rates

    pull = [0.0] * k
    loss, slope, bend, rates = seen(pull)
    best, idle = rates, 0

    def size(r: Rates) -> float:
        return sum(abs(e - t) for e, t in zip(r.expected, r.targets, strict=True)) / total

    while not rates.reached and idle < STALLED:
        floor = max(RIDGE * total, max(bend[i][i] for i in range(k)) * RIDGE)
        step = _solve([[x + (floor if i == j else 0.0) for j, x in enumerate(row)] for i, row in enumerate(bend)], slope)
        descent, length = sum(s * d for s, d in zip(slope, step, strict=True)), 1.0
        if descent <= abs(loss) * 1e-15:
            break  # nowhere lower
        while True:
            ahead = [x - length * d for x, d in zip(pull, step, strict=True)]
            there = seen(ahead)
            if there[0] <= loss - 1e-4 * length * descent or length < 1e-6:
                break
            length /= 2
        pull, (loss, slope, bend, rates) = ahead, there
        idle = 0 if size(rates) < 0.9 * size(best) else idle + 1
        best = min(best, rates, key=size) if ridge < SOFT_RIDGE * total else rates
    return rates if rates.reached else best


def copies_of(rate: Column, key: Column) -> Column:
    """How often a row is used: the rate's whole part, and one more with the chance of the rest, by a hash of the key."""
    chance = F.pmod(F.xxhash64(key, F.lit("mixing")), F.lit(1_000_000)) / 1_000_000
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")).cast("long")


@dataclass(frozen=True)
class Mix:
    classifier: Classifier
    rates: Rates

    def rate(self, member: Column) -> Column:
        return self.rates.of(member)


def memberships(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """``(doc_id, tokens, member)`` per row of ``docs``."""
    worded = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    return worded.select("doc_id", F.size("words").cast("long").alias("tokens"),
                         classifier.memberships(F.col("words")).alias("member"))


def fit(docs: DataFrame, label: str, weights: dict[str, float], at_least: float = 0.0,
        train_rows: int = TRAIN_ROWS) -> tuple[Mix, DataFrame]:
    """The mix, and the table of memberships that it was fitted on. Domains without a weight get none."""
    classifier = train(docs, label, train_rows)
    members = materialize(memberships(docs, classifier), "mixing")
    share = [weights.get(d, 0.0) for d in classifier.domains]
    return Mix(classifier, fit_rates(members, share, at_least) if share else Rates(float(at_least))), members


def mix_documents(docs: DataFrame, label: str = "lang", weights: dict[str, float] | None = None,
                  at_least: float = 0.0) -> DataFrame:
    """``(doc_id, domain, n_tokens, member, rate, copies)`` per row of ``docs``.

    ``domain`` is the likeliest; ``member`` lists the posteriors in the order of the sorted
    labels. Null and empty texts have no tokens and the posteriors of a document without
    telling words. Without any labelled row, domain is null and every rate is 1.
    """
    mix, members = fit(docs, label, weights or WEIGHTS, at_least)
    names = F.array(*[F.lit(d) for d in mix.classifier.domains]).cast("array<string>")
    place = (F.array_position(F.col("member"), F.array_max("member")) - 1).cast("int")
    rated = members.withColumn("rate", mix.rate(F.col("member")))
    return rated.select(
        "doc_id", F.get(names, place).alias("domain"), F.col("tokens").alias("n_tokens"), "member", "rate",
        copies_of(F.col("rate"), F.col("doc_id")).alias("copies"))


def apply_mix(docs: DataFrame, mix: Mix) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as its rate says."""
    worded = docs.select(F.struct(*docs.columns).alias("row"), words_of(F.col("text")).alias("words"))
    times = copies_of(mix.rate(F.col("member")), F.col("row.doc_id"))
    return (worded.select("row", mix.classifier.memberships(F.col("words")).alias("member"))
            .select("row", F.explode(F.array_repeat(F.lit(True), times.cast("int"))).alias("use"))
            .select("row.*"))
