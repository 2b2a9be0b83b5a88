"""Plain versions of the operators that have no SQL, for tables of a few hundred rows."""
from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def merkle(rows: list[tuple]) -> Counter:
    """Rows of (doc_id, source, lang, n_chars, text) to the manifest's rows, paths as plain lists."""
    def leaf(row):
        return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def climb(nodes):
        """The levels of a tree of threes."""
        levels = [list(nodes)]
        while len(levels[-1]) > 1:
            levels.append([digest(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
        return levels

    def steps(levels, at):
        for level in levels[:-1]:
            run = level[at - at % 3:at - at % 3 + 3]
            yield at % 3, run
            at //= 3

    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append((row[0] is not None, row[0] if row[0] is not None else 0, leaf(row), row))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([m[2] for m in sorted(sources[s], key=lambda m: m[:3])]) for s in names}
    top = climb([trees[s][-1][0] for s in names])
    out = Counter()
    for place, s in enumerate(names):
        for at, (_, _, own, row) in enumerate(sorted(sources[s], key=lambda m: m[:3])):
            path = [*steps(trees[s], at), *steps(top, place)]
            proof = digest(*(x for slot, run in path for i, x in enumerate(run) if i != slot))
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None
            node = leaf((*row[:4], row[4].replace("\n", ""))) if changed else own
            for slot, run in path:
                node = digest(*run[:slot], node, *run[slot + 1:])
            out[row[0], own, trees[s][-1][0], top[-1][0], proof, node, node == top[-1][0]] += 1
    return out


def word_counts(rows: list[tuple]) -> Counter:
    """Words of (doc_id, text) rows after misspelling."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                counts[run] += 1
    return counts


def variants(counts: dict[str, int], at_least: int = 5) -> set[tuple]:
    """The spelling groups of words; near words by trying every deletion and wildcard."""
    words = {w: n for w, n in counts.items() if n >= at_least}
    slots = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            slots[w[:i] + "\0" + w[i + 1:]].add(w)  # replaced here
    near = defaultdict(set)
    for alike in slots.values():
        for w in alike:
            near[w] |= alike - {w}
    for w in words:
        for i in range(len(w)):
            if (cut := w[:i] + w[i + 1:]) in words:
                near[w].add(cut)
                near[cut].add(w)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}
