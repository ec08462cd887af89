"""Near-duplicate embeddings: iterative quantisation, multi-index Hamming tables, exact reranking."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import map_arrow, table
from tallyline.llm.components import components
from tallyline.session import stash

COSINE = 0.95
#: Distinct vectors, those of smallest hash, that the rotations are learned from at most.
SAMPLE = 20_000
#: Share of links at the threshold that the tables should find.
RECALL = 0.995
#: Bits of a segment in which two codes may differ to meet: one flipped on either side.
RADIUS = 2


@dataclass(frozen=True)
class Plan:
    """How codes are cut: ``segments`` of ``width`` bits, and the bits in which candidates may differ."""

    width: int
    segments: int
    distance: int

    @property
    def per_word(self) -> int:
        return 62 // self.width

    @property
    def words(self) -> int:
        return -(-self.segments // self.per_word)


def plan(vectors: int, cosine: float = COSINE, recall: float = RECALL) -> Plan:
    """Segments as wide as the logarithm of the number of vectors, so that a table entry holds a few
    vectors whatever their number; and as many segments as it takes for one of them to differ in two bits or
    fewer, with probability ``recall``, between vectors at the threshold. One bit differs with probability
    angle / pi."""
    width = min(31, max(8, math.ceil(math.log2(max(vectors, 2)))))
    p = math.acos(cosine) / math.pi
    near = sum(math.comb(width, i) * p**i * (1 - p) ** (width - i) for i in range(RADIUS + 1))
    segments = max(1, math.ceil(math.log(1 - recall) / math.log(1 - near))) if near < 1 else 1
    bits = width * segments
    return Plan(width, segments, math.ceil(p * bits + 4.5 * math.sqrt(bits * p * (1 - p)) + 1))


@dataclass(frozen=True)
class Codes:
    """Learned projections; a vector's code is the sign of each."""

    mean: np.ndarray
    projection: np.ndarray
    plan: Plan

    def of(self, rows: list[np.ndarray]) -> np.ndarray:
        """Codes packed into longs, ``plan.per_word`` segments in each. Lengths that the projections were not learned for get
        random ones, which keep the angle of two vectors as it is."""
        sizes = np.array([len(r) for r in rows])
        bits = np.zeros((len(rows), self.projection.shape[1]), dtype=bool)
        for size in np.unique(sizes).tolist():
            these = np.flatnonzero(sizes == size)
            x = np.stack([rows[i] / np.abs(rows[i]).max() for i in these.tolist()])
            x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
            if size == len(self.mean):
                bits[these] = (x - self.mean) @ self.projection > 0
            else:
                bits[these] = x @ np.random.default_rng([11, size]).standard_normal((size, bits.shape[1])) > 0
        powers = 1 << np.arange(self.plan.width, dtype=np.int64)
        segments = bits.reshape(len(rows), self.plan.segments, self.plan.width) @ powers
        out = np.zeros((len(rows), self.plan.words), dtype=np.int64)
        for j in range(self.plan.segments):
            out[:, j // self.plan.per_word] |= segments[:, j] << np.int64(self.plan.width * (j % self.plan.per_word))
        return out


def _centred(sample: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = sample / np.maximum(np.linalg.norm(sample, axis=1, keepdims=True), 1e-300)
    mean = x.mean(axis=0) if len(x) else np.zeros(sample.shape[1])
    return mean, x - mean


def centred_cosine(sample: np.ndarray, cosine: float) -> float:
    """The cosine, once the sample's mean is taken from unit vectors, of two that have ``cosine``: the more they share a
    direction, the shorter they become, and the wider the angle of the same difference. Goes by the shortest
    twentieth."""
    _, centred = _centred(sample)
    squares = (centred**2).sum(axis=1)
    shortest = float(np.quantile(squares, 0.05)) if len(squares) else 1.0
    return max(0.0, 1 - (1 - cosine) / max(shortest, 1e-300)) if shortest < 1 else cosine


def quantise(sample: np.ndarray, cut: Plan, rounds: int = 40, seed: int = 11) -> Codes:
    """Iterative quantisation. Unit vectors are centred and turned to their principal axes; then codes
    and rotation are improved in turn: the code is the sign of the rotated vector, the rotation the one
    that brings vectors nearest to their codes (Procrustes). If a code has more bits than the vectors have
    dimensions, further rotations are learned from other starts."""
    size = sample.shape[1]
    mean, centred = _centred(sample)
    _, axes = np.linalg.eigh(centred.T @ centred + 1e-12 * np.eye(size))
    axes = axes[:, ::-1]
    draw, need, out = np.random.default_rng(seed), cut.width * cut.segments, []
    while need > 0:
        bits = min(size, need)
        turned = centred @ axes[:, :bits]
        rotation = np.linalg.qr(draw.standard_normal((bits, bits)))[0]
        for _ in range(rounds if len(centred) else 0):
            u, _, v = np.linalg.svd(np.where(turned @ rotation > 0, 1.0, -1.0).T @ turned)
            rotation = (u @ v).T
        out.append(axes[:, :bits] @ rotation)
        need -= bits
    every = np.concatenate(out, axis=1)
    return Codes(mean, every[:, draw.permutation(every.shape[1])], cut)


def usable(vector: Column) -> Column:
    """Vectors that have a direction: no null or non-finite component, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def _segment(words: list[Column], j: int, cut: Plan) -> Column:
    shifted = F.shiftrightunsigned(words[j // cut.per_word], cut.width * (j % cut.per_word))
    return shifted.bitwiseAND(F.lit((1 << cut.width) - 1))


def candidates(codes: DataFrame, cut: Plan) -> DataFrame:
    """Pairs ``(a, b)`` of nodes, each once, that share a segment up to two bits and whose whole codes differ
    in ``cut.distance`` bits at most.

    Every code is entered in one table a segment, under the segment and under each segment one bit away; two codes
    meet if their segments are within two bits. Of the places where a pair meets, the first segment and
    the smaller entry count, so no pair is formed twice."""
    names = [f"w{i}" for i in range(cut.words)]
    own = [F.col(n) for n in names]
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i).cast("long") for i in range(cut.width)])
    segments = F.array(*[_segment(own, j, cut) for j in range(cut.segments)])
    entered = (
        codes.select("node", *names, F.posexplode(segments).alias("segment", "value"))
        .select("node", *names, "segment", F.explode(F.transform(flips, lambda f: F.col("value").bitwiseXOR(f))).alias("entry"))
    )
    left = entered.toDF("a", *(f"a{i}" for i in range(cut.words)), "segment", "entry")
    right = entered.toDF("b", *(f"b{i}" for i in range(cut.words)), "segment", "entry")
    aw, bw = ([F.col(f"{s}{i}") for i in range(cut.words)] for s in "ab")
    differ = sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(aw, bw, strict=True)), F.lit(0))
    first, earlier = F.lit(False), F.lit(True)
    for j in range(cut.segments):
        x, y = _segment(aw, j, cut), _segment(bw, j, cut)
        low = x.bitwiseXOR(y).bitwiseAND(-x.bitwiseXOR(y))
        first = F.when(left["segment"] == j, earlier & (left["entry"] == F.least(x.bitwiseXOR(low), y.bitwiseXOR(low)))).otherwise(first)
        earlier = earlier & (F.bit_count(x.bitwiseXOR(y)) > RADIUS)
    on = (left["segment"] == right["segment"]) & (left["entry"] == right["entry"]) & (F.col("a") < F.col("b")) & (differ <= cut.distance) & first
    return left.join(right, on).select("a", "b")


def _vectors(column: pa.Array) -> list[np.ndarray]:
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    return [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def links(distinct: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Pairs ``(a, b)`` of ``distinct`` (node, embedding) with a cosine of ``cosine`` or more, in double
    precision from the original vectors. Vectors of different lengths are never linked. The rotations
    are learned from a bounded sample (``SAMPLE``) of the most frequent length, and so is how far two linked vectors' codes
    lie apart; every vector is indexed, those of other lengths by random projections."""
    spark = distinct.sparkSession
    count = distinct.count()
    if not count:
        return spark.createDataFrame([], "a long, b long")
    size = distinct.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").first()["size"]
    chosen = distinct.where(F.size("embedding") == size).orderBy(F.xxhash64("embedding"), "node").limit(SAMPLE).select("embedding").toArrow()
    sample = np.array([v / np.abs(v).max() for v in chosen.column(0).to_pylist()], dtype=np.float64).reshape(-1, size)
    cut = plan(count, centred_cosine(sample, cosine))
    learned = spark.sparkContext.broadcast(quantise(sample, cut))
    names = [f"w{i}" for i in range(cut.words)]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = learned.value.of(_vectors(batch.column("embedding")))
            yield pa.RecordBatch.from_arrays([batch.column("node"), *(pa.array(found[:, i]) for i in range(cut.words))], names=["node", *names])

    codes = stash(map_arrow(distinct.select("node", "embedding"), coded, ", ".join(["node long", *(f"{n} long" for n in names)])), "codes")

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(_vectors(batch.column("left")), _vectors(batch.column("right")), strict=True)):
                if len(x) == len(y):
                    x, y = x / np.abs(x).max(), y / np.abs(y).max()
                    keep[i] = x @ y >= cosine * math.sqrt((x @ x) * (y @ y))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))], names=["a", "b"])

    vectors = distinct.select("node", "embedding")
    pairs = candidates(codes, cut).join(vectors.toDF("a", "left"), "a").join(vectors.toDF("b", "right"), "b")
    return stash(map_arrow(pairs.select("a", "b", "left", "right"), ranked, "a long, b long"), "embedding-links")


def groups(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row of ``vectors`` (vec_id, embedding).

    n_links counts the other vectors linked directly, copies included; component_id is the smallest
    vec_id reachable; a vector is kept if that is its own. Equal vectors are one entry from the start, with a
    count, so copies are never paired. Vectors that are null, zero or have a null or non-finite component
    link with nothing and are their own component. A row that is repeated counts as a copy of itself;
    rows whose vec_id is null count as links, and have no component unless linked to a row with an id."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    own = F.col("embedding") if kind == "array<float>" else F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), own.alias("embedding"))
    fine = rows.where(usable(F.col("embedding")))
    counted = fine.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    distinct = stash(counted.withColumn("node", F.monotonically_increasing_id()), "embeddings")
    near = links(distinct, cosine)
    sides = near.union(near.select("b", "a")).toDF("node", "other")
    degree = sides.join(distinct.select(F.col("node").alias("other"), "copies"), "other").groupBy("node").agg(F.sum("copies").alias("others"))
    rooted = distinct.select("node", "least", "copies", "embedding").join(components(near), "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = rooted.join(named, "root").join(degree, "node", "left").select(
        "embedding", "component_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    linked = fine.join(known, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.coalesce(usable(F.col("embedding")), F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return groups(table(spark, folder, "embeddings").select("vec_id", "embedding"))
