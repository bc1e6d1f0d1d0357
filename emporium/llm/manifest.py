"""Merkle manifest of a table as a persistent tree: a changed row's version copies its ancestors and shares the rest."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import ship
from emporium.operators.numbering import number_within
from emporium.session import stored


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


@dataclass
class Block:
    """A subtree over up to ``width ** height`` consecutive nodes; its levels are lists of hex digests, the lowest first."""

    levels: list[list[str]]
    width: int

    @classmethod
    def over(cls, nodes: list[str], index: int, width: int, height: int) -> Block:
        """The tree of block ``index`` of a row of nodes.

        A block that is not its row's only one is ``height`` levels high, also
        where it is the last and shorter. An only block ends at one node: it is
        block 0 and has fewer than ``width ** height`` nodes, or as many, in
        which case both rules agree.
        """
        levels = [nodes]
        while len(levels) <= height and (index or len(levels[-1]) > 1):
            low = levels[-1]
            levels.append([digest(low[i : i + width]) for i in range(0, len(low), width)])
        return cls(levels, width)

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def siblings(self, place: int) -> list[tuple[str, str]]:
        """For each level on the way up from node ``place``: the run's digests to its left and to its right, joined."""
        out = []
        for low in self.levels[:-1]:
            first = place - place % self.width
            out.append(("".join(low[first:place]), "".join(low[place + 1 : first + self.width])))
            place //= self.width
        return out


def copied(node: str, siblings: Sequence[tuple[str, str]]) -> list[str]:
    """The ancestors that a version with ``node`` in the leaf's place copies, upwards; everything beside the way is shared."""
    out = []
    for left, right in siblings:
        node = digest((left, node, right))
        out.append(node)
    return out


_NODES = "tree string, place long, digest string"
_PATHS = "tree string, place long, lefts array<string>, rights array<string>"


def _block(width: int, height: int) -> Column:
    return F.floor(F.col("place") / F.lit(width**height)).cast("long").alias("block")


def _upper(nodes: DataFrame, width: int, height: int) -> DataFrame:
    """The roots of the blocks of ``nodes`` (tree, place, digest), as nodes of the row above."""

    def roots(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tree, index = key
        block = Block.over(pdf.sort_values("place")["digest"].tolist(), index, width, height)
        return pd.DataFrame({"tree": [tree], "place": [index], "digest": [block.root]})

    return nodes.select("tree", "place", "digest").groupBy("tree", _block(width, height)).applyInPandas(roots, _NODES)


def _rows_of_nodes(nodes: DataFrame, width: int, height: int) -> list[DataFrame]:
    """``nodes`` and the rows of block roots above them, until every tree has one node; all but the first stored."""
    rows = [nodes]
    while (rows[-1].agg(F.max("place")).first()[0] or 0) > 0:
        rows.append(stored(_upper(rows[-1], width, height), "nodes"))
    return rows


def _paths(nodes: DataFrame, above: DataFrame, width: int, height: int) -> DataFrame:
    """For every node the siblings on its way to the root: those in its block, then ``above``, its block's own."""

    def paths(key: tuple, pdf: pd.DataFrame, up: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place", ignore_index=True)
        block = Block.over(pdf["digest"].tolist(), key[1], width, height)
        higher = list(zip(up["lefts"].iloc[0], up["rights"].iloc[0]))
        ways = [block.siblings(i) + higher for i in range(len(pdf))]
        return pd.DataFrame({
            "tree": pdf["tree"], "place": pdf["place"],
            "lefts": [[a for a, _ in way] for way in ways], "rights": [[b for _, b in way] for way in ways],
        })

    blocks = nodes.select("tree", "place", "digest").groupBy("tree", _block(width, height))
    return blocks.cogroup(above.groupBy("tree", F.col("place").alias("block"))).applyInPandas(paths, _PATHS)


def _down(rows: Sequence[DataFrame], above: DataFrame, width: int, height: int) -> DataFrame:
    """The paths of the lowest of ``rows``, from those of the top row's nodes."""
    for nodes in reversed(rows):
        above = stored(_paths(nodes, above, width, height), "paths")
    return above


def _levels(nodes: DataFrame, width: int) -> int:
    """How many levels stand above the only tree of ``nodes``."""
    n, levels = (nodes.agg(F.max("place")).first()[0] or 0) + 1, 0
    while n > 1:
        n, levels = -(-n // width), levels + 1
    return levels


def field(value: Column) -> Column:
    """A value as the leaf holds it: ``-`` if null, else its UTF-8 byte count, a colon and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


_VERSIONS = (
    "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
    "tree string, place long, version_leaf string, copied array<string>"
)


def manifest(
    docs: DataFrame,
    tampered: Mapping[str, Column],
    where: Column,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang",
    order: str = "doc_id",
    width: int = 8,
    height: int = 3,
) -> DataFrame:
    """A Merkle tree over ``docs`` and, for each row that ``where`` names, the version in which that row is tampered with.

    A row's leaf is the digest of its ``columns``. Leaves of one ``group``
    ascend by ``order``; runs of ``width`` become a node until one, the subroot,
    remains; subroots, ordered by group, become the root in the same way. Where
    ``where`` holds, the columns in ``tampered`` have other values: that row's
    version copies the leaf and its ancestors (``version_leaf``, ``copied``, from
    the leaf's parent to the version's root) and shares every other node with
    the tree. ``folded_root`` is the version's root (the tree's, if the row is
    not tampered with), ``verified`` says whether it equals ``root``. One row for
    each row of ``docs``; ``place`` counts the leaves of a ``tree`` from 0.

    Work is done in blocks of ``width ** height`` consecutive leaves, which are
    subtrees of their own: a block's tree is built from its leaves, its root goes
    up as a leaf of the next row, and the siblings above come down to it as one
    row, so a version is copied to the root in its own block's task and no task
    holds more than a block. Places come from a range partitioning, so a group
    with most of the rows is many blocks. Leaves and rows of nodes are stored in
    the shared folder; texts are read once and never shuffled.

    Nulls: a null column is ``-`` in the leaf; null ids come first and null
    groups are a group, the first; a null ``where`` tampers with nothing, nor does
    a null value. Rows that tie in ``order`` ascend by their leaf; repeated rows
    are leaves of their own. An empty table gives no rows. Other columns,
    whatever their names, are not read. Texts are hashed whole.
    """
    ship(docs.sparkSession)
    # A null group becomes "-", which sorts before "=" and whatever follows it.
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    original = leaf(*[F.col(c) for c in columns])
    changed = leaf(*[tampered.get(c, F.col(c)) for c in columns])
    leaves = docs.select(
        tree.alias("tree"), F.col(order).alias("doc_id"), original.alias("digest"), F.when(where, changed).alias("version_leaf")
    )
    # Stored before they are ranged: the range partitioning samples its input first, and would hash every text twice.
    numbered = number_within(stored(leaves, "hashed"), "tree", ["doc_id", "digest"], "place").withColumn("place", F.col("place") - 1)
    rows = _rows_of_nodes(stored(numbered, "leaves"), width, height)

    subroots = rows[-1].select(F.lit("top").alias("top"), F.col("tree").alias("of"), "digest")
    placed = number_within(subroots, "top", ["of"], "place")
    top = _rows_of_nodes(stored(placed.select(F.col("top").alias("tree"), "of", (F.col("place") - 1).alias("place"), "digest"), "subroots"), width, height)
    above_subroots = _levels(top[0], width)
    none = F.array().cast("array<string>")
    ways = _down(top[:-1], top[-1].select("tree", "place", none.alias("lefts"), none.alias("rights")), width, height)
    up = ways.join(top[0].select("place", "of"), "place").select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("place"), "lefts", "rights")
    above = _down(rows[1:-1], up, width, height)

    def versions(key: tuple, pdf: pd.DataFrame, up: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place", ignore_index=True)
        own = pdf["digest"].tolist()
        block = Block.over(own, key[1], width, height)
        higher = list(zip(up["lefts"].iloc[0], up["rights"].iloc[0]))
        # The tree's own nodes on the way up from the block's root.
        base = [block.root, *copied(block.root, higher)]
        root = base[-1]
        proofs, folded, copies = [], [], []
        for i, new in enumerate(pdf["version_leaf"].tolist()):
            way = block.siblings(i) + higher
            proofs.append(digest([side for sides in way for side in sides]))
            copies.append(copied(new, way) if new else None)
            folded.append([new, *copies[-1]][-1] if new else root)
        return pd.DataFrame({
            "id": pdf["id"], "leaf": own, "subroot": base[-1 - above_subroots], "root": root, "proof_sha256": proofs,
            "folded_root": folded, "verified": [f == root for f in folded],
            "tree": pdf["tree"], "place": pdf["place"], "version_leaf": pdf["version_leaf"], "copied": copies,
        })

    # Ids go through as text: a null among whole numbers would turn them into doubles.
    blocks = rows[0].withColumn("id", F.col("doc_id").cast("string")).drop("doc_id").groupBy("tree", _block(width, height))
    out = blocks.cogroup(above.groupBy("tree", F.col("place").alias("block"))).applyInPandas(versions, _VERSIONS)
    return out.select(F.col("id").cast(docs.schema[order].dataType).alias("doc_id"), *out.columns[1:])


def node_versions(versions: DataFrame, width: int = 8) -> DataFrame:
    """``doc_id, tree, level, index, digest``: the nodes that each version holds as its own, leaves at level 0.

    Levels count on through the subroot, where ``tree`` ends and the index is 0,
    to the root.
    """
    own = F.concat(F.array("version_leaf"), F.col("copied"))
    nodes = versions.where("version_leaf IS NOT NULL").select("doc_id", "tree", "place", F.posexplode(own).alias("level", "digest"))
    return nodes.select("doc_id", "tree", "level", F.floor(F.col("place") / F.pow(F.lit(width), "level")).cast("long").alias("index"), "digest")
