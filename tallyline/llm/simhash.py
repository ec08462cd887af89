"""SimHash near-duplicates, found with multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallyline.llm.common import map_arrow, table, texts
from tallyline.llm.components import components
from tallyline.session import stash

WORDS, SEED, DISTANCE = 3, 42, 3
#: Two segments of 32 bits: of three differing bits, one segment holds one at most.
SEGMENT_BITS = 32


def fingerprint(text: str, width: int = WORDS, seed: int = SEED) -> int:
    """Majority of each bit over the XXH64 of all word shingles, repeats included; A-Z is
    lower-cased, words end at ASCII white space. Fewer words make one shingle, none make zero."""
    parts = text.encode().lower().split()
    if not parts:
        return 0
    width = min(width, len(parts))
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    spans = zip(starts[: len(parts) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in spans], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(text) for text in texts(batch.column(1)).to_pylist()]
        bits = np.array(found, dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits)], names=["doc_id", "bits"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, bits)`` of every row; ``bits`` is the fingerprint as a signed long."""
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_arrow(narrow, _fingerprints, "doc_id long, bits long")


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs ``(a, b)`` of different values of ``bits`` that differ in ``distance`` (3 at most) bits
    or fewer; a pair may come twice.

    Every fingerprint is stored under the value of each of its two segments. It looks itself up
    under the same value and under the values with one more bit set: of two fingerprints whose
    segments differ in one bit, exactly one has it set, so either side of the ball suffices. Matches
    are verified on all 64 bits inside the join. Both sides are shuffled whatever their size: Spark takes
    the looked-up values, some 33 rows a fingerprint, for no larger than the fingerprints, and would broadcast them."""
    if not 0 <= distance <= 3:
        raise ValueError("two segments with balls of radius one find distances up to three")
    own = prints.select(F.col("bits").alias("a"))
    halves = F.array(F.col("bits").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned("bits", 32))
    stored = own.select("a", F.posexplode(F.array(
        F.col("a").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned("a", 32))).alias("segment", "value"))
    set_one = F.transform(F.sequence(F.lit(0), F.lit(SEGMENT_BITS - 1)), lambda i: F.col("value").bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    ball = F.array_distinct(F.concat(F.array("value"), set_one))
    asked = (
        prints.select(F.col("bits").alias("b"), F.posexplode(halves).alias("segment", "value"))
        .select("b", "segment", F.explode(ball).alias("value"))
    )
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return (
        stored.join(asked.hint("merge"), (stored.segment == asked.segment) & (stored.value == asked.value) & near & (F.col("a") != F.col("b")))
        .select("a", "b")
    )


def groups(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``(doc_id, bits, component_id)`` for every row of ``docs`` (doc_id, text).

    Documents whose fingerprints differ in ``distance`` bits or fewer are linked; component_id is
    the smallest doc_id reachable. Equal fingerprints are reduced to one row before any pair is
    formed, so a group of copies, however large, costs a map-side minimum. Null texts count as
    empty; texts without words have fingerprint zero and are linked like others; a repeated row
    comes out as often as it came in; rows whose doc_id is null take part, but never name a
    component (null if no row of it has an id). An empty table gives an empty result."""
    return _rooted(docs, distance).select("doc_id", "bits", "component_id")


def _rooted(docs: DataFrame, distance: int) -> DataFrame:
    """``groups`` with ``root``, which tells components apart whose smallest ids are the same."""
    prints = stash(fingerprints(docs), "simhash")
    least = stash(prints.groupBy("bits").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(links(least.select("bits"), distance)).toDF("bits", "root")
    rooted = stash(least.join(roots, "bits", "left").select("bits", "least", F.coalesce("root", "bits").alias("root")), "simhash-roots")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = rooted.join(named, "root").select("bits", "root", "component_id")
    return prints.join(by_print, "bits")


def deduplicate(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """One document of each group: the one with the smallest doc_id, once if its row is repeated. Where
    texts that are no near-duplicates share a doc_id, each is in a group of its own; of a group's rows with the
    smallest doc_id, the one with the smallest fingerprint and then the first text stays. Rows without a doc_id
    cannot be named by a group and stay. Columns stay as they are."""
    named = docs.where("doc_id is not null")
    first = _rooted(named, distance).where("doc_id = component_id").groupBy("root", "doc_id").agg(F.min("bits").alias("bits"))
    kept = stash(first.groupBy("doc_id").agg(F.collect_set("bits").alias("kept_bits")), "simhash-kept")
    every = stash(named.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id"), "simhash-repeated")
    once = named.join(kept, "doc_id", "left_semi").join(every, "doc_id", "left_anti").select(*docs.columns)
    again = named.join(every, "doc_id", "left_semi").select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = map_arrow(again, _marked, StructType([*again.schema.fields, StructField("bits", LongType())]))
    chosen = marked.join(kept.select("doc_id", "kept_bits"), "doc_id").where(F.array_contains("kept_bits", F.col("bits")))
    order = Window.partitionBy("doc_id", "bits").orderBy("text", F.to_json("row"))
    chosen = chosen.withColumn("place", F.row_number().over(order)).where("place = 1").select("row.*")
    return once.unionByName(chosen).unionByName(docs.where("doc_id is null"))


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [fingerprint(text) for text in texts(batch.column(2)).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.array(found, dtype=np.uint64).view(np.int64))], names=["row", "doc_id", "text", "bits"])


def query(spark: SparkSession, folder: str) -> DataFrame:
    found = groups(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")
