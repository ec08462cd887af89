"""Ranked lexical search turned round: the items are indexed, the documents pass by.

An inverted index over the items' terms is broadcast, a block of items at a time; every document's counts of those
terms stream through it, and each task keeps a bounded heap of the best documents an item. The heaps are merged
in two steps. Documents are split into words once for each block of items, whatever the number of items in it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.common import PUNCTUATION, Lookup, map_arrow, passes, table, words
from tallyline.session import stash

#: Results for each item.
BEST = 10
#: Items, and pairs of an item and a term, in a block; together they bound what is broadcast (some 20 bytes a pair)
#: and the heaps of a task.
BLOCK_ITEMS, BLOCK_PAIRS = 4_096, 2_000_000
#: Scores of (document, item), and additions to them, that a task holds at a time; one document at least.
_CELLS = 1_000_000
#: First step of merging heaps: so many parts an item.
_PARTS = 64
#: Text bytes of items, and rows, for each task that stores or returns what grows with the items alone: each task
#: makes a file, and the shuffle partitions are as many as the documents need.
_TASK_BYTES, _TASK_ROWS = 8 << 20, 1_000_000


def _tasks(amount: int, each: int) -> int:
    return max(1, -(-amount // each))


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The terms of every item's text, as hashes."""
    for whole in batches:
        for batch in passes(whole):
            found = words(batch.column("text"), PUNCTUATION)
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(found.owner)), pa.array(found.hashes.view(np.int64))], names=["item_id", "term"])


def item_terms(items: DataFrame) -> DataFrame:
    """``(item_id, term)``, each once. Rows with one item_id are one item with the terms of all of them; a null
    item_id is an item of its own."""
    narrow = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return map_arrow(narrow, _terms, "item_id long, term long").distinct().coalesce(_tasks(size, _TASK_BYTES))


def blocks(pairs: DataFrame, most_items: int = BLOCK_ITEMS, most_pairs: int = BLOCK_PAIRS) -> list[DataFrame]:
    """The pairs of a stored table in blocks of whole items: as many blocks as it takes for none to exceed either bound,
    except for a single item that does so by itself."""
    total = pairs.count()
    sizes = stash(pairs.groupBy("item_id").agg(F.count("*").alias("pairs")).coalesce(_tasks(total, _TASK_ROWS)), "search-items")
    count = max(_tasks(sizes.count(), most_items), _tasks(total, most_pairs))
    while True:
        block = F.pmod(F.xxhash64("item_id"), F.lit(count))
        fullest = sizes.groupBy(block.alias("block")).agg(F.count("*").alias("items"), F.sum("pairs").alias("pairs"))
        over = fullest.where((F.col("items") > most_items) | ((F.col("pairs") > most_pairs) & (F.col("items") > 1)))
        if count == 1 or over.isEmpty():
            return [pairs.where(block == i) for i in range(count)]
        count *= 2


@dataclass(frozen=True)
class Index:
    """Terms of a block of items, numbered in order of their hashes, and the items of each term."""

    ids: np.ndarray  # item_id by item number
    missing: np.ndarray  # whether it is null
    terms: np.ndarray  # hash by term number
    begin: np.ndarray  # where a term's items begin in ``items``
    items: np.ndarray

    @classmethod
    def of(cls, pairs: pa.Table) -> Index:
        named = pairs.column("item_id").combine_chunks().dictionary_encode(null_encoding="encode")
        item = named.indices.to_numpy()
        terms, term = np.unique(pairs.column("term").to_numpy().view(np.uint64), return_inverse=True)
        order = np.lexsort((item, term))
        begin = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(terms)))])
        ids = named.dictionary
        return cls(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), terms, begin, item[order].astype(np.int32))


def _counted(index) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Lookup(index.value.terms, np.arange(len(index.value.terms), dtype=np.int64), -1)
        for whole in batches:
            for batch in passes(whole):
                found = words(batch.column("text"), PUNCTUATION)
                term = known.get(found.hashes)
                key, times = np.unique(found.owner[term >= 0] << 32 | term[term >= 0], return_counts=True)
                ends = np.searchsorted(key >> 32, np.arange(batch.num_rows + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(t))) for x, t in ((key & 0xFFFFFFFF, np.int32), (times, np.int64))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.sizes), *lists], names=["doc_id", "n", "terms", "times"])

    return run


@dataclass
class Heaps:
    """The best documents of every item so far, at most ``best`` each: scores, ids and whether an id is null."""

    best: int
    count: int
    item: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    score: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    doc: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    missing: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    def least(self) -> np.ndarray:
        """What a document must score to enter an item's heap; documents with that score may."""
        out = np.ones(self.count, dtype=np.int64)
        full = np.bincount(self.item, minlength=self.count) >= self.best
        low = np.full(self.count, np.iinfo(np.int64).max)
        np.minimum.at(low, self.item, self.score)
        return np.where(full, low, out)

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, missing: np.ndarray) -> None:
        item, score, doc, missing = (np.concatenate(p) for p in ((self.item, item), (self.score, score), (self.doc, doc), (self.missing, missing)))
        order = np.lexsort((doc, missing, -score, item))
        sizes = np.bincount(item, minlength=self.count)
        place = np.arange(len(item)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        keep = order[place < self.best]
        self.item, self.score, self.doc, self.missing = item[keep], score[keep], doc[keep], missing[keep]


def scores(owner: np.ndarray, term: np.ndarray, times: np.ndarray, m: np.ndarray, index: Index, weight: np.ndarray, rows: int) -> np.ndarray:
    """Scores of ``rows`` documents for all items, from their term counts; whole numbers throughout. ``m``: by document."""
    part = weight[term] * ((1_000_000_000 * times) // (1_000 * times + 8 * m[owner]))
    size = index.begin[term + 1] - index.begin[term]
    first = np.repeat(index.begin[term] - (np.cumsum(size) - size), size)
    item = index.items[first + np.arange(int(size.sum()))]
    out = np.zeros(rows * len(index.ids), dtype=np.int64)
    np.add.at(out, np.repeat(owner, size) * len(index.ids) + item, np.repeat(part, size))
    return out.reshape(rows, len(index.ids))


def _ranked(index, weight, documents: int, length: int, best: int) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, w = index.value, weight.value
        heaps = Heaps(best, len(block.ids))
        spread = np.diff(block.begin)
        for whole in batches:
            lists = whole.column("terms")
            sizes = np.diff(lists.offsets.to_numpy())
            steps = np.concatenate([[0], np.cumsum(spread[lists.flatten().to_numpy()])])[np.concatenate([[0], np.cumsum(sizes)])]
            steps += np.arange(len(sizes) + 1) * len(block.ids)
            start = 0
            while start < whole.num_rows:
                stop = max(start + 1, int(np.searchsorted(steps, steps[start] + _CELLS, side="right")) - 1)
                batch, start = whole.slice(start, stop - start), stop
                n, inverse = np.unique(batch.column("n").to_numpy(), return_inverse=True)
                m = np.array([10 + 90 * int(x) * documents // length for x in n], dtype=np.int64)[inverse]
                term, times = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("terms", "times"))
                owner = np.repeat(np.arange(batch.num_rows), np.diff(batch.column("terms").offsets.to_numpy()))
                found = scores(owner, term, times, m, block, w, batch.num_rows)
                row, item = np.nonzero(found >= heaps.least())
                ids = batch.column("doc_id")
                doc, missing = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
                heaps.add(item, found[row, item], doc[row], missing[row])
        ids = pa.array(block.ids[heaps.item], mask=block.missing[heaps.item])
        yield pa.RecordBatch.from_arrays([ids, pa.array(heaps.doc, mask=heaps.missing), pa.array(heaps.score)], names=["item_id", "doc_id", "score"])

    return run


def _merge(heaps: DataFrame, within: list[str], best: int) -> DataFrame:
    order = Window.partitionBy(*within).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def _search_block(narrow: DataFrame, index: Index, best: int) -> DataFrame:
    spark = narrow.sparkSession
    shared = spark.sparkContext.broadcast(index)  # BLOCK_PAIRS pairs at most, or one item
    counted = stash(map_arrow(narrow, _counted(shared), "doc_id long, n long, terms array<int>, times array<long>"), "search-counts")
    total = counted.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    held = counted.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()  # a row a term of the block
    df = np.zeros(len(index.terms), dtype=np.int64)
    df[held.column("term").to_numpy()] = held.column("count").to_numpy()
    documents, length = total["documents"], total["length"]
    weight = np.array([math.floor(1_000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)
    run = _ranked(shared, spark.sparkContext.broadcast(weight), documents, length, best)
    return map_arrow(counted.where(F.size("terms") > 0), run, "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, best: int = BEST, most_items: int = BLOCK_ITEMS, most_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``best`` documents of every item with a score above 0.

    ``docs`` (doc_id, text), ``items`` (item_id, text); further columns are not read. Terms are runs of letters,
    digits and characters beyond ASCII, A-Z lower-cased; words are compared by 64-bit hashes. Every row of ``docs`` is a document, also one that
    repeats another or its id; equal scores go by ascending doc_id, null ids last. Null and empty texts, on either
    side, have no terms: such documents are never found, such items find none. Texts of any length are
    split in windows. Empty tables give no rows. Blocks change no result."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pairs = stash(item_terms(items), "search-pairs")
    found, count = None, 0
    for block in blocks(pairs, most_items, most_pairs):
        index = Index.of(block.toArrow())
        if found is not None and not len(index.ids):
            continue
        count += len(index.ids)
        part = _search_block(narrow, index, best)
        found = part if found is None else found.unionByName(part)
    split = found.withColumn("part", F.pmod(F.xxhash64("doc_id", "score"), F.lit(_PARTS)))
    merged = _merge(_merge(split, ["item_id", "part"], best), ["item_id"], best).select("item_id", "rank", "doc_id", "score")
    return merged.coalesce(_tasks(count * _PARTS * best, _TASK_ROWS))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
