"""A Merkle manifest of a dataset: leaves, subtree roots, one root, and proofs that fold to it.

Rows are numbered along their tree, and every run of ``SUPERBLOCK`` numbers is a superblock. Going
up, each superblock is reduced to one node, and these nodes make the superblocks of the next level until one
node a tree is left; the trees' roots are the leaves of a last tree. Going down, the nodes of a level and the
outer nodes that a superblock needs (the siblings above it, up to the root) are cogrouped by superblock: one
group function reduces the superblock again, joins both halves of the proofs and folds them. A group
holds a superblock and a few dozen outer nodes, however large a tree is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import ship, table
from tallyline.operators.ordering import number_rows
from tallyline.session import stash

#: Levels of a tree that one group reduces; a superblock holds two to the power of it nodes.
LEVELS = 10
#: The fields of a document that its leaf covers, in order; fixed values.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NODES = "tree string, position long, total long, digest string"
_OUTER = "tree string, block long, rank int, side int, digest string"
# What an outer node is to the path: the sibling before it, the one after it, or a root that the path passes.
_BEFORE, _AFTER, _SUBROOT, _ROOT = -1, 1, 0, 2


def digest(*parts: str) -> str:
    """Lowercase hex SHA-256 of the concatenated parts."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(field: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon, and the value."""
    value = field.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(f) for f in fields]).cast("binary"), 256)


def tampered_rows(key: Column) -> Column:
    """Rows whose text is tampered with: 7 divides the CRC-32 of the decimal id; a null id is left alone."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 7 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """``(tree, doc_id, leaf, other)``: every row's leaf, and the leaf of its tampered version (null
    where the row is not tampered with). A tree holds the rows of one language; its name is empty for null, else
    ``=`` and the language, so that names sort as languages do, null first."""
    columns = [F.col(c) for c in FIELDS]
    changed = [F.col(c).cast("decimal(20,0)") + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(columns).alias("leaf"),
        F.when(tampered_rows(F.col("doc_id")), leaf_digest(changed)).alias("other"),
    )


def _levels(total: int, levels: int) -> int:
    """How often a superblock is reduced: until one node is left of a tree that is one superblock,
    else by all its levels."""
    return levels if total > 1 << levels else max(total - 1, 0).bit_length()


def _reduce(nodes: list[str], times: int) -> list[list[str]]:
    """The nodes of a superblock level by level, the given ones first. A last node without a partner
    is hashed alone."""
    out = [nodes]
    for _ in range(times):
        last = out[-1]
        out.append([digest(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return out


def _siblings(levels: list[list[str]], at: int) -> list[tuple[int, str]]:
    """Siblings of node ``at`` inside its superblock, from its level upwards."""
    path = []
    for level in levels[:-1]:
        other = at ^ 1
        if other < len(level):
            path.append((_AFTER if other > at else _BEFORE, level[other]))
        else:
            path.append((_AFTER, ""))
        at >>= 1
    return path


def fold(leaf: str, path: Sequence[tuple[int, str]]) -> str:
    """The root that a leaf and its siblings give; an empty sibling is none, roots on the path are passed."""
    for side, other in path:
        if side == _AFTER:
            leaf = digest(leaf, other)
        elif side == _BEFORE:
            leaf = digest(other, leaf)
    return leaf


def proof(path: Sequence[tuple[int, str]]) -> str:
    """One digest of the siblings on a path, in order."""
    return digest(*[other for side, other in path if side in (_BEFORE, _AFTER)])


def _block(levels: int) -> Column:
    return F.shiftright("position", levels)


def _up(nodes: DataFrame, levels: int) -> DataFrame:
    """One node for each superblock: the next level's nodes, with their positions and number."""

    def reduced(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("position")
        total = int(rows["total"].iloc[0])
        top = _reduce(list(rows["digest"]), _levels(total, levels))[-1][0]
        return pd.DataFrame({"tree": [key[0]], "position": [key[1]], "total": [-(-total >> levels)], "digest": [top]})

    ship(nodes.sparkSession)
    return nodes.withColumn("block", _block(levels)).groupBy("tree", "block").applyInPandas(reduced, _NODES)


def _cogrouped(nodes: DataFrame, outer: DataFrame, levels: int, emit: Callable, schema: str) -> DataFrame:
    """Nodes and the outer nodes of their superblock meet in one group; ``emit(row, at, path)`` gives a node's
    result rows from its whole path to the root."""
    columns = [f.split()[0] for f in schema.split(", ")]

    def joined(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(rows):
            rows = rows.sort_values("position")
            inner = _reduce(list(rows["digest"]), _levels(int(rows["total"].iloc[0]), levels))
            above = above.sort_values("rank")
            beyond = list(zip(above["side"].tolist(), above["digest"].tolist(), strict=True))
            for at, row in enumerate(rows.itertuples(index=False)):
                out += emit(row, _siblings(inner, at) + beyond)
        return pd.DataFrame.from_records(out, columns=columns)

    ship(nodes.sparkSession)
    left = nodes.withColumn("block", _block(levels)).groupBy("tree", "block")
    return left.cogroup(outer.groupBy("tree", "block")).applyInPandas(joined, schema)


def _pass_down(row, path) -> list[tuple]:
    """A node's path, as outer nodes of the superblock below it."""
    return [(row.tree, row.position, rank, side, other) for rank, (side, other) in enumerate(path)]


def _verified(row, path) -> list[tuple]:
    root, subroot = (next(d for side, d in path if side == mark) for mark in (_ROOT, _SUBROOT))
    folded = fold(row.other if isinstance(row.other, str) else row.digest, path)
    return [(row.id if isinstance(row.id, str) else None, row.digest, subroot, root, proof(path), folded, folded == root)]


@dataclass(frozen=True)
class Forest:
    """Levels of all trees, leaves first; each level is one node for every superblock of the one before,
    the last one holds a node a tree."""

    levels: list[DataFrame]
    width: int

    @classmethod
    def over(cls, nodes: DataFrame, width: int) -> Forest:
        found = [nodes]
        while not found[-1].where("total > 1").isEmpty():
            found.append(stash(_up(found[-1], width), "merkle-level"))
        return cls(found, width)

    def down(self, outer: DataFrame) -> DataFrame:
        """Outer nodes for the superblocks of the leaves, from those of the trees' roots."""
        for level in reversed(self.levels[1:]):
            outer = stash(_cogrouped(level, outer, self.width, _pass_down, _OUTER), "merkle-outer")
        return outer


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """One row for every row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Rows of a language make a tree in ascending order of doc_id, null ids first, equal ids by
    leaf; rows equal in all five fields are leaves of their own, side by side. Nulls in any field are encoded as ``-``, a
    null language is a tree of its own, the first one. Texts are hashed whole by the JVM, so their length does not
    matter here. An empty table gives no rows. Further columns are not read. ``levels`` sets the size of
    a superblock and changes no result."""
    spark = docs.sparkSession
    # Equal rows need an order to be spread over ranges; any will do, as they are interchangeable.
    made = stash(leaves(docs), "merkle-leaves").withColumn("tie", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.col("leaf").asc(), F.col("tie").asc()]
    # Ids travel as text: pandas would make floats of whole numbers where some are null.
    numbered = stash(
        number_rows(made, "n", order, within=["tree"], total="total").select(
            "tree", (F.col("n") - 1).alias("position"), "total", F.col("leaf").alias("digest"), F.col("doc_id").cast("string").alias("id"), "other"
        ),
        "merkle-numbered",
    )
    trees = Forest.over(numbered, levels)
    roots = stash(trees.levels[-1].select("tree", "digest"), "merkle-roots")
    top = number_rows(roots, "n", [F.col("tree").asc()], total="total")
    top = stash(top.select(F.lit("").alias("tree"), (F.col("n") - 1).alias("position"), "total", "digest", F.col("tree").alias("name")), "merkle-top")
    forest = Forest.over(top, levels)
    root = forest.levels[-1].select("tree", F.lit(0).cast("long").alias("block"), F.lit(0).alias("rank"), F.lit(_ROOT).alias("side"), "digest")

    def of_tree(row, path) -> list[tuple]:
        return [(row.name, 0, rank, side, other) for rank, (side, other) in enumerate([(_SUBROOT, row.digest), *path])]

    outer = _cogrouped(top, forest.down(root), levels, of_tree, _OUTER)
    schema = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    whole = _cogrouped(numbered, trees.down(stash(outer, "merkle-outer")), levels, _verified, schema)
    return whole.select(F.col("id").cast("long").alias("doc_id"), *whole.columns[1:])


def query(spark: SparkSession, folder: str) -> DataFrame:
    return manifest(table(spark, folder, "documents").select(*FIELDS))
