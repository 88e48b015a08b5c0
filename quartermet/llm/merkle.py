"""Merkle manifest of a table, with a proof for each row, by incremental witnesses.

Each row is a leaf: the digest of its columns.  The leaves of one tree (one value
of a column, NULL is one too) ascend by a key; each two consecutive nodes become
the digest of their digests, the last of an odd number the digest of itself alone,
until one is left, the subroot.  The subroots, ordered by the column's value (NULL
first, then by UTF-8 bytes), become the root in the same way.

Leaves are appended in order to blocks that start at multiples of ``2 ** BITS``.
A block keeps the open subtrees of an incomplete tree; a leaf that is appended
closes those of its own size, and whatever a closed subtree holds learns its
sibling there: its witness grows by one step.  The roots of blocks are appended
in the same way in the next round, so a tree of any size is built by tasks of
bounded size, and their witnesses are the later steps of all their leaves.

Rows are numbered by ranges of key (``numbered``), texts are read once and never
shuffled.  NULL keys come first; rows of equal keys are ordered by their leaf, and
equal rows stand for themselves.  NULL columns have a form of their own in a leaf,
apart from empty ones.  A table without rows has no manifest rows.  Columns that
are not named are not read.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ranking import numbered
from .common import batch_of, stored

#: A block holds at most 2 ** BITS nodes.
BITS = 12
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Steps of a witness: L and R stand for a sibling on that side, A for a node that is alone.
WITNESS = "tree string, n long, at long, digest string, sides string, siblings binary, root string"


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


class Accumulator:
    """A tree that grows to the right, with the witnesses of its nodes."""

    def __init__(self) -> None:
        self.sides: list[list[str]] = []
        self.siblings: list[list[str]] = []
        #: Height, digest, first and last node of each open subtree; heights fall.
        self.open: list[tuple[int, str, int, int]] = []

    def _learn(self, first: int, last: int, side: str, sibling: str = "") -> None:
        for i in range(first, last):
            self.sides[i].append(side)
            self.siblings[i].append(sibling)

    def _put(self, height: int, node: str, first: int, last: int) -> None:
        while self.open and self.open[-1][0] == height:
            _, left, begin, _ = self.open.pop()
            self._learn(begin, first, "R", node)
            self._learn(first, last, "L", left)
            height, node, first = height + 1, digest(left, node), begin
        self.open.append((height, node, first, last))

    def append(self, node: str) -> None:
        self.sides.append([])
        self.siblings.append([])
        self._put(0, node, len(self.sides) - 1, len(self.sides))

    def close(self, height: int = 0) -> str:
        """The root, at least ``height`` levels up: a node without a sibling is raised alone."""
        while len(self.open) > 1 or self.open[0][0] < height:
            low, node, first, last = self.open.pop()
            self._learn(first, last, "A")
            self._put(low + 1, digest(node), first, last)
        return self.open[0][1]


def _block(rows: pa.Table, bits: int) -> pa.Table:
    """The witnesses of a block's nodes within it, and its root."""
    rows = rows.sort_by("at")
    n, tree = rows["n"][0].as_py(), Accumulator()
    for node in rows["digest"].to_pylist():
        tree.append(node)
    root = tree.close(bits if n > 1 << bits else 0)
    return pa.Table.from_batches([batch_of(WITNESS, [
        rows["tree"].combine_chunks(), rows["n"].combine_chunks(), rows["at"].combine_chunks(), rows["digest"].combine_chunks(),
        ["".join(x) for x in tree.sides], [bytes.fromhex("".join(x)) for x in tree.siblings], [root] * len(rows),
    ])])


def grow(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """Whole witnesses of ``nodes`` (tree, n: nodes of the tree, at: place from 0, digest), and their tree's root."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    rounds: list[DataFrame] = []
    while True:
        block = F.shiftright("at", bits).alias("block")
        made = stored(nodes.groupBy("tree", block).applyInArrow(lambda rows: _block(rows, bits), WITNESS), "witnesses")
        rounds.append(made)
        if most <= 1 << bits:
            break
        most = (most + (1 << bits) - 1) >> bits
        above = F.shiftright(F.col("n") + ((1 << bits) - 1), bits)
        first = F.col("at").bitwiseAND((1 << bits) - 1) == 0
        nodes = made.where(first).select(
            "tree", above.alias("n"), F.shiftright("at", bits).alias("at"), F.col("root").alias("digest")
        )
    whole = rounds.pop()
    while rounds:
        later = whole.select(
            "tree", F.col("at").alias("block"), F.col("sides").alias("later_sides"),
            F.col("siblings").alias("later_siblings"), F.col("root").alias("whole_root"),
        )
        lower = rounds.pop().withColumn("block", F.shiftright("at", bits))
        whole = lower.join(later, ["tree", "block"]).select(
            "tree", "n", "at", "digest", F.concat("sides", "later_sides").alias("sides"),
            F.concat("siblings", "later_siblings").alias("siblings"), F.col("whole_root").alias("root"),
        )
    return whole


def leaf(columns: dict[str, Column] | tuple[str, ...] = COLUMNS) -> Column:
    """Digest of a row's columns: ``-`` for NULL, else the number of bytes, a colon, the value."""
    values = columns.values() if isinstance(columns, dict) else [F.col(f"`{c}`") for c in columns]
    forms = []
    for value in values:
        value = value.cast("string")
        forms.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*forms).cast("binary"), 256)


def manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = COLUMNS,
    key: str = "doc_id",
    tree: str = "lang",
    carry: dict[str, Column] | None = None,
    bits: int = BITS,
) -> DataFrame:
    """One row for each of ``docs``: key, tree, at, leaf, sides, siblings, subroot, root, and ``carry``.

    ``sides`` and ``siblings`` (32 bytes for each L and R) lead from the leaf to the root.
    """
    carry = carry or {}
    leaves = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.coalesce(F.concat(F.lit("1"), F.col(f"`{tree}`").cast("string")), F.lit("0")).alias("tree"),
        leaf(columns).alias("digest"),
        F.monotonically_increasing_id().alias("uid"),
        *(made.alias(f"carry_{name}") for name, made in carry.items()),
    )
    rows = stored(numbered(leaves, ["tree"], ["key", "digest", "uid"], "place", "n"), "leaves")
    rows = rows.withColumn("at", F.col("place") - 1)
    trees = grow(rows.select("tree", "n", "at", "digest"), bits)
    crown = trees.where("at = 0").select("tree", F.col("root").alias("digest"))
    crown = stored(numbered(crown, [], ["tree"], "place", "n").withColumn("at", F.col("place") - 1), "crown")
    tops = grow(crown.select(F.lit("").alias("tree"), "n", "at", "digest"), bits).select(
        "at", F.col("sides").alias("top_sides"), F.col("siblings").alias("top_siblings"), F.col("root").alias("top")
    )
    # Written, so that Spark knows how large it is before it joins all rows to it.
    tops = stored(tops.join(crown.select("at", "tree"), "at").drop("at"), "tops")
    found = rows.join(trees.drop("digest", "n"), ["tree", "at"]).join(tops, "tree")
    return found.select(
        F.col("key").alias(key),
        F.when(F.col("tree") != "0", F.substring("tree", 2, 1 << 30)).alias(tree),
        "at", F.col("digest").alias("leaf"), F.concat("sides", "top_sides").alias("sides"),
        F.concat("siblings", "top_siblings").alias("siblings"), F.col("root").alias("subroot"), F.col("top").alias("root"),
        *(F.col(f"carry_{name}").alias(name) for name in carry),
    )


@F.pandas_udf(T.StringType())
def fold(leaves: pd.Series, sides: pd.Series, siblings: pd.Series) -> pd.Series:
    """The root that a leaf and its witness lead to."""

    def one(node: str, steps: str, others: bytes) -> str:
        at = 0
        for side in steps:
            if side == "A":
                node = digest(node)
                continue
            other = others[at : at + 32].hex()
            at += 32
            node = digest(other, node) if side == "L" else digest(node, other)
        return node

    return pd.Series([one(*x) for x in zip(leaves, sides, siblings, strict=True)], dtype=object)
