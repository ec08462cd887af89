"""Connected components of a link table, by contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import map_arrow
from tallyline.session import stash

_LINKS = "a long, b long"


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one partition as a forest with the same components: a row per node that is
    not a root. Works batch by batch; memory follows the nodes, not the links."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            x, parent[x] = parent.get(x, x), top
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    for start in range(0, len(nodes), 50_000):
        part = nodes[start : start + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int64()), pa.array([root(x) for x in part], pa.int64())], names=["a", "b"]
        )


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (columns a, b: long, no nulls); nodes with one
    root are connected, and the root is one of them.

    Each round, every node joins its neighbour of smallest hash (or stays, if its own is
    smaller), the links move to the nodes that were joined, and links within one node go. The hash
    makes long chains shrink by a constant factor however their ids are ordered, so rounds grow
    with the logarithm of the longest chain. Before each round every partition replaces its links by
    a spanning forest, so groups of many links are thin before they are shuffled; a node with many
    neighbours is reduced by map-side minima. All tables are written to the shared scratch folder.
    An empty link table gives an empty result; repeated and self links change nothing.
    """
    rest = stash(map_arrow(links.select("a", "b"), _forest, _LINKS), "links")
    rounds: list[DataFrame] = []
    while not rest.isEmpty():
        both = rest.union(rest.select("b", "a")).toDF("node", "other")
        best = both.groupBy("node").agg(F.min(F.struct(F.xxhash64("other").alias("h"), F.col("other").alias("id"))).alias("best"))
        step = stash(
            best.select("node", F.when(F.col("best.h") < F.xxhash64("node"), F.col("best.id")).otherwise(F.col("node")).alias("root")),
            "step",
        )
        rounds.append(step)
        moved = (
            rest.join(step.toDF("a", "left"), "a")
            .join(step.toDF("b", "right"), "b")
            .where("left <> right")
            .select(F.col("left").alias("a"), F.col("right").alias("b"))
        )
        rest = stash(map_arrow(moved, _forest, _LINKS), "links")
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    found = rounds[0]
    for step in rounds[1:]:
        found = (
            found.join(step.toDF("root", "next"), "root", "left")
            .select("node", F.coalesce("next", "root").alias("root"))
        )
    return found
