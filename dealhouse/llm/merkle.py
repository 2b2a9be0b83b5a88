"""Merkle manifest of a document table as a tree of SHA-256 midstates.

A leaf is the digest of a row, a source's leaves ascend by doc_id, and every three nodes in a
row become their parent up to the source's subroot; the subroots become the root likewise.
A parent keeps a copy of its hash state from before each child slot. To fold a changed node
upwards, the state of its slot is resumed and absorbs the replacement and the siblings to
its right; nothing to its left is hashed again.

A task builds whole blocks of ``ARITY ** LEVELS`` nodes, so a table takes as many rounds as
its largest source has powers of that size, and a source of any size is spread over its
blocks. On the way back every block meets one row with the path above it. A hash state can be
copied but not written down, so between tasks it travels as the digests it has absorbed; the
block absorbs them once and copies the state for each of its leaves.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealhouse.llm.common import map_rows, materialize
from dealhouse.llm.ranks import positions

ARITY = 3
LEVELS = 5
BLOCK = ARITY ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


class Subtree:
    """The nodes of a block, level by level; parents keep a hash state for each child slot."""

    def __init__(self, nodes: Sequence[str], levels: int) -> None:
        self.levels: list[list[str]] = [list(nodes)]
        self.states: list[list] = []
        for _ in range(levels):
            below, above, kept = self.levels[-1], [], []
            for first in range(0, len(below), ARITY):
                state = sha256()
                for child in below[first:first + ARITY]:
                    kept.append(state.copy())
                    state.update(child.encode())
                above.append(state.hexdigest())
            self.levels.append(above)
            self.states.append(kept)

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def path(self, at: int) -> list[tuple[str, str]]:
        """The joined siblings to the left and to the right of node ``at``, level by level."""
        found = []
        for level in self.levels[:-1]:
            first = at - at % ARITY
            found.append(("".join(level[first:at]), "".join(level[at + 1:first + ARITY])))
            at //= ARITY
        return found

    def fold(self, at: int, node: str, path: list[tuple[str, str]]) -> str:
        """The block's top if ``node`` stood at ``at``."""
        for kept, (_, right) in zip(self.states, path, strict=True):
            node = resume(kept[at], node, right)
            at //= ARITY
        return node


def resume(state, node: str, right: str) -> str:
    """A parent's digest from the state before a slot, the slot's node and what is right of it."""
    state = state.copy()
    state.update((node + right).encode())
    return state.hexdigest()


def height(n: int) -> int:
    """Levels from ``n`` nodes up to one."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def _digest(columns: dict[str, F.Column]) -> F.Column:
    shown = []
    for name in FIELDS:
        text = columns[name].cast("string")
        shown.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*shown), 256)


def tampered(doc_id: F.Column) -> F.Column:
    """Whether the query tampers with a row; never where doc_id is null."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 2 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, leaf, other)``; ``other`` is the leaf of a tampered row, else null."""
    columns = {c: F.col(c) for c in FIELDS}
    changed = {**columns, "text": F.replace(columns["text"], F.lit("\n"), F.lit(""))}
    return docs.select("doc_id", columns["source"].cast("string"), _digest(columns).alias("leaf"),
                       F.when(tampered(F.col("doc_id")), _digest(changed)).alias("other"))


def _block() -> F.Column:
    return F.expr(f"pos div {BLOCK}")


def _in_blocks(rows: DataFrame, *inner: str) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", *inner)


def ascend(nodes: DataFrame) -> list[DataFrame]:
    """``(tree, pos, n, node)`` and the rounds above it; in the last each tree is one node."""

    def fold(source: Iterator[tuple]) -> Iterator[tuple]:
        for (tree, block), members in groupby(source, lambda r: r[:2]):
            digests, n = [], 0
            for _, _, n, node in members:
                digests.append(node)
            yield tree, block, -(-n // BLOCK), Subtree(digests, min(LEVELS, height(n))).top

    rounds = [nodes]
    while (rounds[-1].agg(F.max("n")).first()[0] or 0) > 1:
        blocks = _in_blocks(rounds[-1].withColumn("block", _block()), "pos")
        rounds.append(materialize(
            map_rows(blocks, ["tree", "block", "n", "node"], fold, T.StructType(
                [nodes.schema[c] for c in ("tree", "pos", "n", "node")])), "merkle"))
    return rounds


PATH = T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())])


def _with_paths(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """The rows of each block, after the row with the path above it."""
    below = nodes.withColumn("block", _block())
    above = paths.select("tree", F.col("pos").alias("block"), "above", "subroot", "root")
    return _in_blocks(above.unionByName(below, allowMissingColumns=True), F.col("pos").asc_nulls_first())


def _descend(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """The paths of a round's nodes, from those of the round above."""

    def walk(source: Iterator[tuple]) -> Iterator[tuple]:
        for (tree, _), members in groupby(source, lambda r: r[:2]):
            *_, above, subroot, root = next(members)
            held = list(members)
            block = Subtree([r[4] for r in held], min(LEVELS, height(held[0][3])))
            for at, (_, _, pos, *_) in enumerate(held):
                path = [{"left": a, "right": b} for a, b in block.path(at)]
                yield tree, pos, path + above, subroot, root

    rows = _with_paths(nodes, paths)
    return map_rows(rows, ["tree", "block", "pos", "n", "node", "above", "subroot", "root"], walk,
                    paths.select("tree", "pos", "above", "subroot", "root").schema)


def _proofs(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Every leaf's proof, and the root that its row now folds to."""

    def walk(source: Iterator[tuple]) -> Iterator[tuple]:
        for _, members in groupby(source, lambda r: r[:2]):
            *_, above, subroot, root = next(members)
            upper = [(sha256(p["left"].encode()), p["right"]) for p in above]
            beyond = "".join(p["left"] + p["right"] for p in above)
            held = list(members)
            block = Subtree([r[4] for r in held], min(LEVELS, height(held[0][3])))
            for at, (_, _, _, _, leaf, doc_id, other, *_) in enumerate(held):
                path = block.path(at)
                node = block.fold(at, other or leaf, path)
                for state, right in upper:
                    node = resume(state, node, right)
                proof = "".join(left + right for left, right in path) + beyond
                yield doc_id, leaf, subroot, root, sha256(proof.encode()).hexdigest(), node, node == root

    text = [T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
    return map_rows(
        _with_paths(nodes, paths),
        ["tree", "block", "pos", "n", "node", "doc_id", "other", "above", "subroot", "root"], walk,
        T.StructType([nodes.schema["doc_id"], *text, T.StructField("verified", T.BooleanType())]))


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root and proof of every row of ``docs``, and whether it still verifies.

    Null fields count as ``-``, so a null and an empty text differ. A null source is a source
    of its own, before the others; null ids come first in theirs and are never tampered with.
    Rows with equal ids follow one another by digest; equal rows are leaves of their own.
    An empty table has no rows. Further columns are not looked at.
    """
    known = materialize(leaves(docs), "merkle-leaves")
    placed = positions(known, ["source"], ["doc_id", "leaf"], "merkle-leaves").select(
        F.col("source").alias("tree"), "pos", "n", F.col("leaf").alias("node"), "doc_id", "other")
    placed = materialize(placed, "merkle-leaves")
    rounds = ascend(placed.select("tree", "pos", "n", "node"))
    subroots = materialize(positions(rounds[-1].select("tree", "node"), [], ["tree"], "merkle-sources"), "merkle-sources")
    tops = ascend(subroots.select(F.lit(None).cast("string").alias("tree"), "pos", "n", "node"))
    paths = tops[-1].select("tree", "pos", F.array().cast(T.ArrayType(PATH)).alias("above"),
                            F.col("node").alias("subroot"), F.col("node").alias("root"))
    for nodes in reversed(tops[:-1]):
        paths = materialize(_descend(nodes, paths), "merkle")
    paths = subroots.select("tree", "node", F.col("pos").alias("at")).join(
        paths.select("pos", "above", "root"), F.col("pos") == F.col("at")).select(
        "tree", F.lit(0).cast("long").alias("pos"), "above", F.col("node").alias("subroot"), "root")
    for nodes in reversed(rounds[1:-1]):
        paths = materialize(_descend(nodes, paths), "merkle")
    return _proofs(placed, paths)
