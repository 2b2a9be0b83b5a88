"""Personal data spans: fixed patterns, and a weakly supervised classifier that adds to them.

Base spans (email, ip, card, phone) come from exact patterns and always stay. Looser
candidates (spelled-out addresses, digit groups and joins of neighbouring ones) are put to
five labelers: the strict pattern, a validity check, a gazetteer, the words before the
span, and its borders.
Expectation-maximisation over all candidates of the corpus estimates how reliable each
labeler is for each kind; its posteriors train a logistic classifier of the span's shape
and votes, and candidates that it accepts are added.

A candidate is described by a pattern number (votes and shape bits), so the corpus reduces
to counts per kind and pattern: a table of bounded size, whatever the input. Matching is
linear in a text's length.
"""
from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealhouse.llm.common import bound_batches, map_rows

KINDS = ("email", "ip", "card", "phone")
LABELERS = 5
SHAPE_BITS = 7
ACCEPT = 0.9  # chance from which the classifier adds a candidate

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run that fails fails from its inside as well, so matches are tried at its start only.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")

AT_SIGN = re.compile(r" ?[\[(] ?(?:at|AT|@) ?[\])] ?")
DOT_HOST = re.compile(r"[A-Za-z0-9-]+(?:(?:\.| ?[\[(] ?(?:dot|DOT|\.) ?[\])] ?)[A-Za-z0-9-]+)+")
GROUPS = re.compile(r"[0-9](?:[ ().-]{0,2}[0-9])++")
GROUP = re.compile(r"[0-9]+")
LOOSE_IP = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
INSIDE = re.compile(r"(?<=[0-9])[ ().-]{1,2}(?=[0-9])")
TO_LEFT = re.compile(r"[0-9]([ ().-]{1,2})$")
TO_RIGHT = re.compile(r"([ ().-]{1,2})[0-9]")
LOOSE_DIGITS = 19  # of the longest loose candidate

# Gazetteers and context words; fixed values.
TOP_LEVEL = frozenset("com org net edu gov info io co de fr es uk eu us it nl ch at be ca au".split())
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45",
                 "46", "47", "48", "49", "52", "55", "61", "62", "81", "82", "86", "91")
CONTEXT = {
    "email": ("mail", "contact", "kontakt", "correo", "courriel", "write to"),
    "ip": ("ip", "address", "server", "host", "login"),
    "card": ("card", "visa", "master", "amex", "karte", "carte", "tarjeta", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "kontakt", "contact", "handy", "fono"),
}
AGAINST = ("version", "license", "isbn", "issn", "order", "invoice", "token", "key", "id", "doi", "page")
BEFORE = 32  # characters read for context
DOUBLED = str.maketrans("0123456789", "0246813579")  # each digit doubled, less nine from ten on


def luhn(digits: str) -> bool:
    return sum(map(int, digits[-1::-2] + digits[-2::-2].translate(DOUBLED))) % 10 == 0


def _digits(s: str) -> str:
    return "".join(GROUP.findall(s))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the fixed patterns, by kind, then start."""
    out = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    if DIGITS.search(text):
        if "." in text:
            out += [(1, m.start(), m.end()) for m in IP.finditer(text)
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = _digits(m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def loose_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """Candidates beside the fixed patterns: spelled-out addresses, and digit groups.

    Of a run of digit groups, each group and each join of neighbouring ones is offered, up to
    ``LOOSE_DIGITS`` digits from each start; candidates may overlap.
    """
    if "(" in text or "[" in text:
        for m in AT_SIGN.finditer(text):
            left, host = m.start(), DOT_HOST.match(text, m.end())
            while left and text[left - 1] in LOCAL:
                left -= 1
            if left < m.start() and host:
                yield 0, left, host.end()
    if DIGITS.search(text):
        for m in GROUPS.finditer(text):
            groups = [g.span() for g in GROUP.finditer(text, m.start(), m.end())]
            for first, (start, _) in enumerate(groups):
                n = 0
                for at, end in groups[first:]:
                    n += end - at
                    if n > LOOSE_DIGITS:
                        break
                    if 8 <= n <= 15 and start and text[start - 1] == "+":
                        yield 3, start - 1, end
                    elif n >= 4 and LOOSE_IP.fullmatch(text, start, end):
                        yield 1, start, end
                    elif n >= 13:
                        yield 2, start, end
                    elif n >= 7:
                        yield 3, start, end


def _strict(kind: int, span: str, digits: str) -> bool:
    """Whether a card or phone, cut from its run, fits its fixed pattern."""
    if kind == 2:
        return 16 <= len(digits) <= 19 and CARD.fullmatch(span) is not None and luhn(digits)
    return kind == 3 and 8 <= len(digits) <= 15 and PHONE.fullmatch(span) is not None


def _cut_like_inside(text: str, start: int, end: int) -> bool:
    """Whether digits go on beyond an end of the span behind a separator that also stands inside it."""
    left, right = TO_LEFT.search(text[max(0, start - 3):start]), TO_RIGHT.match(text, end)
    if not left and not right:
        return False
    inside = set(INSIDE.findall(text[start:end]))
    return bool(left and left[1] in inside or right and right[1] in inside)


def describe(text: str, kind: int, start: int, end: int, base: bool) -> int:
    """The candidate's pattern number: five votes (0 against, 1 abstains, 2 for) and shape bits."""
    span = text[start:end]
    digits = _digits(span)
    before = text[max(0, start - BEFORE):start].lower()
    strict = base or _strict(kind, span, digits)
    alone = not (start and text[start - 1].isalnum()) and not (end < len(text) and text[end].isalnum())
    if kind == 0:
        valid = "." in span or "dot" in span.lower()
        known = re.split(r"[^A-Za-z]+", span.rstrip())[-1].lower() in TOP_LEVEL
    elif kind == 1:
        valid = all(int(p) <= 255 for p in span.split(".") if len(p) < 10)
        known = not span.startswith("0")
    elif kind == 2:
        valid, known = luhn(digits), digits[0] in "3456"
    else:
        valid = 10 <= len(digits) <= 15 and len(set(digits)) > 2
        known = digits.startswith(CALLING_CODES) and strict
    context = 2 if any(w in before for w in CONTEXT[KINDS[kind]]) else 0 if any(w in before for w in AGAINST) else 1
    # Where only an equal separator tells the span from the digits beside it, its borders are open.
    borders = 0 if not alone else 1 if kind > 0 and not base and _cut_like_inside(text, start, end) else 2
    votes = (2 if strict else 1, 2 if valid else 0, 2 if known else 1, context, borders)
    shape = (len(digits) >= 10, len(digits) >= 13, len(digits) in (15, 16), " " in span, "-" in span or "." in span,
             "(" in span or "[" in span, span[:1] == "+")
    number = 0
    for v in votes:
        number = 3 * number + v
    return number << SHAPE_BITS | sum(b << i for i, b in enumerate(shape))


def candidates(text: str | None) -> list[tuple[int, int, int, bool, int]]:
    """``(kind, start, end, base, pattern)``: base spans, then loose ones that touch none of them."""
    text = text or ""
    base = base_spans(text)
    out = [(k, s, e, True, describe(text, k, s, e, True)) for k, s, e in base]
    taken = sorted((s, e) for _, s, e in base)
    starts, reach = [s for s, _ in taken], [0]
    for _, e in taken:
        reach.append(max(reach[-1], e))
    for k, s, e in sorted(loose_spans(text), key=lambda x: (x[1], x[0], x[2])):
        if reach[bisect_left(starts, e)] <= s:  # no base span that begins before this one's end goes beyond its start
            out.append((k, s, e, False, describe(text, k, s, e, False)))
    return out


# --- labeler reliabilities and the classifier -------------------------------------------

def votes_of(patterns: np.ndarray) -> np.ndarray:
    numbers = patterns >> SHAPE_BITS
    return np.stack([numbers // 3 ** (LABELERS - 1 - i) % 3 for i in range(LABELERS)], axis=1)


def _features(kinds: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    votes = votes_of(patterns) - 1.0
    shape = (patterns[:, None] >> np.arange(SHAPE_BITS)) & 1
    return np.hstack([np.eye(len(KINDS))[kinds], votes, shape])


@dataclass
class SpanModel:
    """``reliability[kind, labeler, state, vote]`` and the classifier's weights."""

    reliability: np.ndarray = field(default_factory=lambda: np.zeros((len(KINDS), LABELERS, 2, 3)))
    weights: np.ndarray | None = None  # None: there was nothing to learn from; nothing is added
    known: dict[tuple[int, int], float] = field(default_factory=dict, repr=False, compare=False)

    def chance(self, kind: int, pattern: int) -> float:
        if self.weights is None:
            return 0.0
        got = self.known.get((kind, pattern))
        if got is None:  # patterns are few
            x = _features(np.array([kind]), np.array([pattern]))[0] @ self.weights
            got = self.known[kind, pattern] = float(1 / (1 + np.exp(-x)))
        return got

    def accepts(self, kind: int, pattern: int) -> bool:
        return self.chance(kind, pattern) >= ACCEPT


def expectation_maximisation(kinds, patterns, rows, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Dawid-Skene over counted vote patterns: each pattern's posterior, and the reliabilities.

    Labelers start as, and are drawn to, right in four of five votes.
    """
    votes = votes_of(patterns)
    posterior = 1 / (1 + np.exp(-(votes - 1.0).sum(axis=1)))
    lean = np.array([[0.4, 0.4, 0.1], [0.1, 0.4, 0.4]]) * 20
    reliability = np.zeros((len(KINDS), LABELERS, 2, 3))
    for _ in range(rounds):
        logs = np.zeros((len(rows), 2))
        for kind in range(len(KINDS)):
            at = kinds == kind
            weight = np.stack([rows[at] * (1 - posterior[at]), rows[at] * posterior[at]])
            logs[at] = np.log((weight.sum(axis=1) + 5) / (weight.sum() + 10))
            for labeler in range(LABELERS):
                counts = lean + np.stack([[weight[z][votes[at, labeler] == v].sum() for v in range(3)] for z in (0, 1)])
                reliability[kind, labeler] = counts / counts.sum(axis=1, keepdims=True)
                logs[at] += np.log(reliability[kind, labeler][:, votes[at, labeler]]).T
        posterior = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))
    return posterior, reliability


def fit_patterns(counts: list[tuple[int, int, int]]) -> SpanModel:
    """Model from ``(kind, pattern, rows)``."""
    if not counts:
        return SpanModel()
    kinds, patterns, rows = (np.array(x) for x in zip(*sorted(counts), strict=True))
    posterior, reliability = expectation_maximisation(kinds, patterns, rows.astype(float))
    x, w = _features(kinds, patterns), rows.astype(float)

    def loss(beta: np.ndarray) -> float:
        return float(w @ (np.logaddexp(0, x @ beta) - posterior * (x @ beta)) + beta @ beta / 2)

    beta = np.zeros(x.shape[1])
    for _ in range(100):  # Newton steps, halved until they gain, of a ridge logistic regression on soft labels
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -500, 500)))
        slope = x.T @ (w * (p - posterior)) + beta
        curve = (x * (w * p * (1 - p))[:, None]).T @ x + np.eye(len(beta))
        move, now = np.linalg.solve(curve, slope), loss(beta)
        if slope @ move <= 1e-12 * now:
            break
        size = 1.0
        while loss(beta - size * move) > now and size > 1e-9:
            size /= 2
        beta = beta - size * move
    return SpanModel(reliability, beta)


CANDIDATE = T.StructType([
    T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("base", T.BooleanType()), T.StructField("pattern", T.IntegerType())])


def find_candidates(docs: DataFrame) -> DataFrame:
    """``(doc_id, found)`` per row of ``docs``: all candidate spans of the whole text."""
    names = CANDIDATE.names

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, text in source:
            yield doc_id, [dict(zip(names, c, strict=True)) for c in candidates(text)]

    return map_rows(docs, ["doc_id", "text"], rows, T.StructType([
        docs.schema["doc_id"], T.StructField("found", T.ArrayType(CANDIDATE))]))


def fit(found: DataFrame) -> SpanModel:
    """Reliabilities and classifier from every candidate of the corpus, counted by pattern."""
    counts = found.select(F.explode("found").alias("c")).groupBy("c.kind", "c.pattern").agg(
        F.count(F.lit(1)).alias("rows"))
    return fit_patterns([tuple(r) for r in counts.collect()])  # a row per kind and pattern at most


def decide(found: list[tuple[int, int, int, bool, int]], model: SpanModel) -> list[tuple[int, int, int]]:
    """Base spans and accepted candidates, by kind, then start.

    An accepted candidate that lies wholly within likelier ones, or longer ones as likely,
    adds nothing and goes; whatever any accepted candidate covers stays covered.
    """
    out = [(k, s, e) for k, s, e, base, _ in found if base]
    added = [(k, s, e, model.chance(k, p)) for k, s, e, base, p in found if not base and model.accepts(k, p)]
    covered: list[tuple[int, int]] = []  # disjoint, in order; touches no base span
    for k, s, e, _ in sorted(added, key=lambda x: (-x[3], x[1] - x[2], x[1], x[0])):
        at = bisect_left(covered, (s + 1,)) - 1
        if at >= 0 and covered[at][1] >= e:
            continue
        out.append((k, s, e))
        first = at if at >= 0 and covered[at][1] >= s else at + 1
        last = first
        while last < len(covered) and covered[last][0] <= e:
            s, e, last = min(s, covered[last][0]), max(e, covered[last][1]), last + 1
        covered[first:last] = [(s, e)]
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def report(found: DataFrame, model: SpanModel) -> DataFrame:
    """Counts of base spans, digest of them, and all spans, per row of ``found``.

    Null and empty texts have no spans: zero counts, the digest of an empty string, and an
    empty ``spans``.
    """
    fields = [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]

    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, spans in source:
            got = [tuple(c.values()) for c in spans]
            base = sorted((k, s, e) for k, s, e, is_base, _ in got if is_base)
            yield (doc_id, *(sum(b[0] == k for b in base) for k in range(len(KINDS))),
                   hashlib.sha256(joined(base).encode()).hexdigest(), joined(decide(got, model)))

    return map_rows(found, ["doc_id", "found"], rows, T.StructType([
        found.schema["doc_id"], *fields, T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType())]))


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its kind in brackets."""
    out, done = [], 0
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= done:
            out += [text[done:s], f"[{KINDS[k].upper()}]"]
        done = max(done, e)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, model: SpanModel) -> DataFrame:
    """``docs``, all columns, with the spans in ``text`` masked and ``n_chars``, if there, brought up to date.

    Null texts stay null; texts without spans stay as they are.
    """
    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                columns = list(part.columns)
                old = columns[names.index("text")].to_pylist()
                new = [t if t is None else mask(t, decide(candidates(t), model)) for t in old]
                columns[names.index("text")] = pa.array(new, type=part.schema.field("text").type)
                if "n_chars" in names:
                    sizes = columns[names.index("n_chars")]
                    columns[names.index("n_chars")] = pa.array(
                        [n if t == o else len(t) for n, t, o in zip(sizes.to_pylist(), new, old, strict=True)],
                        type=sizes.type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return bound_batches(docs).mapInArrow(run, schema)
