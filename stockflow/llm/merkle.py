"""Merkle manifest of a table: leaves, roots and a membership proof per row.

Leaves of a group stand in the order of their ids. Every two consecutive nodes
become the hash of their digests one behind the other; a last node without a
partner becomes the hash of its own digest, until one node, the group's root,
remains. The roots of the groups are the leaves of one more such tree.

Proofs are kept up while nodes are appended: a block of consecutive leaves is a
stream whose complete subtrees wait on a stack, and each subtree that meets its
sibling hands its digest on to the witnesses of the sibling's leaves. Block
roots are appended to blocks of block roots in the same way, until each group
has one root; a leaf's proof is its own witness followed by those of its blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import ROW, numbered
from stockflow.operators.joins import join_lookup
from stockflow.operators.moving_average import with_row_numbers
from stockflow.session import materialize, spread

BLOCK_LEVELS = 10  # a block has at most 2 ** 10 nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of texts, one behind the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_hash(*fields: Column) -> Column:
    """Hash of a row: of each field its size in bytes, a colon and its value."""
    texts = [f.cast("string") for f in fields]
    return digest(
        *[
            F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
            for t in texts
        ]
    )


def fold(leaf: Column, proof: Column) -> Column:
    """The root that follows from a leaf and its proof."""
    return F.aggregate(proof, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def siblings(proof: Column) -> Column:
    """The digests of a proof, one behind the other."""
    return F.concat_ws("", F.transform(proof, lambda step: F.concat(step["left"], step["right"])))


class OpenTree:
    """Complete subtrees of a growing row of nodes, and the nodes' witnesses."""

    def __init__(self) -> None:
        self.open: list[tuple[int, str, int]] = []  # height, root, first node
        self.witnesses: list[list[tuple[str, str]]] = []

    def append(self, node: str) -> None:
        self.open.append((0, node, len(self.witnesses)))
        self.witnesses.append([])
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            self._join()

    def _join(self) -> None:
        height, right, middle = self.open.pop()
        _, left, first = self.open.pop()
        for witness in self.witnesses[first:middle]:
            witness.append(("", right))
        for witness in self.witnesses[middle:]:
            witness.append((left, ""))
        root = hashlib.sha256((left + right).encode()).hexdigest()
        self.open.append((height + 1, root, first))

    def close(self, height: int | None) -> str:
        """The root at this height, or where one node remains, without more nodes."""
        while len(self.open) > 1 or (height is not None and self.open[0][0] < height):
            if len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
                self._join()
                continue
            level, lone, first = self.open.pop()
            for witness in self.witnesses[first:]:
                witness.append(("", ""))
            self.open.append((level + 1, hashlib.sha256(lone.encode()).hexdigest(), first))
        return self.open[0][1]


def witnesses_of_blocks(levels: int):
    """Witnesses of nodes that come block by block, in order; roots of the blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, block, height, rows, held = OpenTree(), None, None, [], []

        def closed() -> pa.RecordBatch:
            root = tree.close(height)
            steps = [step for witness in tree.witnesses for step in witness]
            proof = pa.ListArray.from_arrays(
                pa.array([0, *_running(map(len, tree.witnesses))], pa.int32()),
                pa.StructArray.from_arrays(
                    [pa.array([s[side] for s in steps], pa.string()) for side in (0, 1)],
                    ["left", "right"],
                ),
            )
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([block[0]] * len(rows), pa.string()),
                    pa.array(rows, pa.int64()),
                    pa.concat_arrays(held),
                    proof,
                    pa.array([root] + [None] * (len(rows) - 1), pa.string()),
                ],
                ["tree", "place", "row", "proof", "root"],
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("tree", "place", "node", "nodes")]
            seen = 0  # rows of the batch that are held already
            for at, (name, place, node, nodes) in enumerate(zip(*columns, strict=True)):
                if (name, place >> levels) != block:
                    if rows:
                        held.append(batch.column("row")[seen:at])
                        yield closed()
                    seen = at
                    tree, rows, held, block = OpenTree(), [], [], (name, place >> levels)
                    height = levels if nodes > 1 << levels else None
                tree.append(node)
                rows.append(place)
            held.append(batch.column("row")[seen:])
        if rows:
            yield closed()

    return run


def _running(counts: Iterator[int]) -> Iterator[int]:
    total = 0
    for count in counts:
        total += count
        yield total


def proofs(nodes: DataFrame, levels: int = BLOCK_LEVELS) -> tuple[DataFrame, DataFrame]:
    """Proofs (``tree``, ``row``, ``proof``) of all nodes, and the roots of all trees.

    ``nodes`` is a written table with ``tree``, ``place`` (0, 1, ... within the
    tree), ``node`` (digest), ``nodes`` (size of the tree) and ``row`` (anything).
    """
    layers = []
    while True:
        block = F.shiftright("place", levels)
        dealt = spread(nodes.withColumn("block", block), "tree", "block")
        dealt = dealt.sortWithinPartitions("tree", "place").drop("block")
        kind = nodes.schema["row"].dataType.simpleString()
        layer = materialize(
            dealt.mapInArrow(
                witnesses_of_blocks(levels),
                f"tree string, place bigint, row {kind}, proof {PROOF}, root string",
            ),
            "witnesses",
        )
        layers.append(layer)
        largest = nodes.agg(F.max("nodes")).first()[0] or 0
        roots = layer.filter("root is not null")
        if largest <= 1 << levels:
            break
        sizes = nodes.groupBy("tree").agg(F.max("nodes").alias("nodes"))
        above = join_lookup(
            roots.select("tree", F.shiftright("place", levels).alias("place"), "root"),
            sizes,
            ["tree"],
        )
        nodes = materialize(
            above.select(
                "tree",
                "place",
                F.col("root").alias("node"),
                F.shiftright(F.col("nodes") + ((1 << levels) - 1), levels).alias("nodes"),
                F.lit(0).alias("row"),
            ),
            "roots",
        )
    whole = layers[-1].select("tree", "place", "row", "proof")
    for layer in reversed(layers[:-1]):
        upper = whole.select("tree", F.col("place").alias("block"), F.col("proof").alias("rest"))
        lower = layer.withColumn("block", F.shiftright("place", levels))
        joined = join_lookup(lower, upper, ["tree", "block"])
        whole = joined.select("tree", "place", "row", F.concat("proof", "rest").alias("proof"))
    return whole, roots.select("tree", "root")


def placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with their ``place`` within the ``tree`` and the ``nodes`` of it."""
    rows = with_row_numbers(nodes, ["tree", *order])
    trees = rows.groupBy("tree").agg(F.min("__row").alias("__first"), F.count("*").alias("nodes"))
    rows = join_lookup(rows, trees, ["tree"])
    rows = rows.withColumn("place", F.col("__row") - F.col("__first"))
    return materialize(rows.select("tree", "place", "node", "nodes", "row"), "nodes")


def merkle_manifest(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    group_col: str = "lang",
    fields: tuple[str, ...] = FIELDS,
    keep: tuple[str, ...] = (),
    levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """One row per row of ``docs``: its id as ``doc_id``, the columns named in
    ``keep``, ``leaf``, ``subroot`` (of its group), ``root`` and ``proof`` (from
    the leaf to the root).

    Null ids come first in their group, rows with equal ids follow each other by
    their leaves, equal rows have different places. A null group is a group of
    its own before all others; a null field counts as ``-``, an empty text as
    ``0:``. An empty table has no rows. Other columns are not read.
    """
    group = F.col(group_col).cast("string")
    leaf = leaf_hash(*[F.col(f) for f in fields])
    leaves = docs.select(
        # Groups keep their order bytewise, with the null group in front.
        F.coalesce(F.concat(F.lit("="), group), F.lit("-")).alias("tree"),
        F.col(id_col).alias("id"),
        leaf.alias("node"),
        F.struct(F.col(id_col).alias("doc_id"), *keep, leaf.alias("leaf")).alias("row"),
    )
    # The written row number keeps apart rows that are equal in everything.
    leaves = numbered(leaves, "leaves").withColumnRenamed(ROW, "copy")
    proof, roots = proofs(placed(leaves, ["id", "node", "copy"]), levels)
    trees = roots.select(
        F.lit("").alias("tree"),
        F.col("tree").alias("name"),
        F.col("root").alias("node"),
        F.struct("tree", "root").alias("row"),
    )
    last, top = proofs(placed(trees, ["name"]), levels)
    root = top.first()
    last = last.select("row.tree", F.col("row.root").alias("subroot"), F.col("proof").alias("rest"))
    return join_lookup(proof, last, ["tree"]).select(
        "row.*",
        "subroot",
        F.lit(root["root"] if root else None).cast("string").alias("root"),
        F.concat("proof", "rest").alias("proof"),
    )
