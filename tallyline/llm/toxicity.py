"""Toxicity from class-conditional Kneser-Ney models with shared backoff counts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import PUNCTUATION, Lookup, fold, free_name, map_arrow, pair_hash, passes, sums, table, words
from tallyline.session import stash

#: Labelled rows per class that the models learn from at most, those of smallest hash.
ROWS_PER_CLASS = 2_000
#: Words in the windows whose highest ratio is a feature.
WINDOWS = (2, 8, 32, 128, 512)
#: A word counts once within so many words.
REPEAT = 16
_FEATURES = 3 + len(WINDOWS)
_START = np.uint64(0x8F3A_77C1_5D20_E94B)


def _pairs(column: pa.Array):
    """Words of the texts, and the hash of each word before it (a start mark before the first)."""
    found = words(column, PUNCTUATION)
    before = np.empty_like(found.hashes)
    before[1:] = found.hashes[:-1]
    first = found.first[:-1][found.sizes > 0]
    before[first] = _START
    return found, before


@dataclass(frozen=True)
class Ratios:
    """Log-likelihood ratios, toxic over ordinary: of known word pairs, and of backing off (the
    history's part and the word's part)."""

    pair: Lookup
    history: Lookup
    word: Lookup

    def of(self, found, before) -> tuple[np.ndarray, np.ndarray]:
        """The ratio of every word by the whole model, and by its lower order alone."""
        word = self.word.get(found.hashes).astype(np.float64)
        known = self.pair.get(pair_hash(before, found.hashes))
        return np.where(np.isnan(known), self.history.get(before) + word, known), word


def _discount(counts: np.ndarray) -> float:
    """Ney's estimate n1 / (n1 + 2 n2)."""
    one, two = int((counts == 1).sum()), int((counts == 2).sum())
    return one / (one + 2 * two) if one and two else 0.5


def fit_ratios(counts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Ratios:
    """``counts``: for the ordinary and the toxic class, pairs as (before, word, times).

    Each class has an interpolated Kneser-Ney bigram model. Its lower order is the class's own
    continuation counts, which in turn back off to counts that the classes share: in how many of
    them a word occurs at all, and a uniform rest for words never seen. An expression that is rare
    in both classes so gets nearly the same probability from either."""
    both_before, both_word = (np.concatenate([c[i] for c in counts]) for i in (0, 1))
    keys, at = np.unique(pair_hash(both_before, both_word), return_index=True)
    vocabulary, classes = np.unique(np.concatenate([np.unique(c[1]) for c in counts]), return_counts=True)
    total_shared = classes.sum() + 1.0
    shared, rest = classes / total_shared, 1.0 / total_shared
    history_all = np.unique(both_before)
    word_log, unknown_log, history_log, pair_log = [], [], [], []
    for before, word, times in counts:
        seen, follows = np.unique(word, return_counts=True)
        cut, types = _discount(follows), max(len(word), 1)
        own = np.zeros(len(vocabulary))
        own[np.searchsorted(vocabulary, seen)] = np.maximum(follows - cut, 0) / types
        spare = cut * len(seen) / types if len(word) else 1.0
        lower = own + spare * shared
        word_log.append(np.log(lower))
        unknown_log.append(float(np.log(spare * rest)))
        cut = _discount(times)
        starts, inverse = np.unique(before, return_inverse=True)
        total, kinds = np.bincount(inverse, weights=times), np.bincount(inverse)
        back = np.zeros(len(history_all))
        back[np.searchsorted(history_all, starts)] = np.log(cut * kinds / total)
        history_log.append(back)
        high = np.zeros(len(keys))
        place = np.searchsorted(keys, pair_hash(before, word))
        high[place] = np.maximum(times - cut, 0) / total[inverse]
        low = lower[np.searchsorted(vocabulary, both_word[at])]
        pair_log.append(np.log(high + np.exp(back[np.searchsorted(history_all, both_before[at])]) * low))
    word_ratio = (word_log[1] - word_log[0]).astype(np.float32)
    return Ratios(
        Lookup(keys, (pair_log[1] - pair_log[0]).astype(np.float32), np.nan),
        Lookup(history_all, (history_log[1] - history_log[0]).astype(np.float32)),
        Lookup(vocabulary, word_ratio, unknown_log[1] - unknown_log[0]),
    )


def _fresh(found, window: int) -> np.ndarray:
    """Whether a word did not occur among the ``window`` words before it in its text: a word said
    over and over is no more evidence than said once."""
    key = pair_hash(found.owner.astype(np.uint64), found.hashes)
    order = np.argsort(key, kind="stable")
    again = (key[order][1:] == key[order][:-1]) & (np.diff(order) <= window)
    out = np.ones(len(key), dtype=bool)
    out[order[1:][again]] = False
    return out


def features(column: pa.Array, ratios: Ratios) -> np.ndarray:
    """Per text: the ratio per word by the whole model and by its lower order; the highest sum of
    the latter over each of ``WINDOWS`` words in a row, divided by the window's length; and the
    logarithm of the number of words. All are normalised by length, but the windows also see a
    few words in a long text."""
    found, before = _pairs(column)
    count, n = len(found.sizes), np.maximum(found.sizes, 1)
    fresh = _fresh(found, REPEAT)
    both, lower = (np.where(fresh, each, 0.0) for each in ratios.of(found, before))
    total = sums(lower, found.owner, count)
    out = [sums(both, found.owner, count) / n, total / n]
    run = np.concatenate([[0.0], np.cumsum(lower)])
    for window in WINDOWS:
        peak = total / np.maximum(n, window)
        if len(lower) >= window:
            means = (run[window:] - run[:-window]) / window
            whole = found.owner[: len(means)] == found.owner[window - 1 :]
            np.maximum.at(peak, found.owner[: len(means)][whole], means[whole])
        out.append(peak)
    return np.column_stack([*out, np.log1p(found.sizes)])


@dataclass(frozen=True)
class Model:
    ratios: Ratios | None
    weights: np.ndarray

    def score(self, column: pa.Array) -> np.ndarray:
        if self.ratios is None:
            return np.full(len(column), self.weights[0])
        x = features(column, self.ratios)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[1:] + self.weights[0], -50, 50)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weighted logistic regression by Newton's method on standardised features."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    b = np.zeros(z.shape[1])
    penalty = np.diag([1e-6] + [ridge] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + penalty
        step = np.linalg.solve(h, z.T @ (weight * (y - p)) - penalty @ b)
        b = b + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    slopes = b[1:] / scale
    return np.concatenate([[b[0] - slopes @ mean], slopes])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word pairs of each batch by half and class, with their counts."""
    for whole in batches:
        for batch in passes(whole):
            found, before = _pairs(batch.column("text"))
            half, toxic = (batch.column(c).to_numpy(zero_copy_only=False)[found.owner] for c in ("half", "toxic"))
            for group in range(4):
                own = (half * 2 + toxic) == group
                left, right = before[own], found.hashes[own]
                _, at, times = np.unique(pair_hash(left, right), return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), group)), *(pa.array(side[at].view(np.int64)) for side in (left, right)), pa.array(times)],
                    names=["kind", "before", "word", "times"],
                )


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """Learn from labelled documents.

    ``labels`` (doc_id, toxic): rows with a null in either are ignored, a document labelled both
    ways is toxic. Per class, the ``rows_per_class`` documents of smallest hash are used: a bounded
    sample, so the models and what is sent around do not grow with the corpus. Word pairs are counted
    in Spark. The weights of the features are fitted on scores of documents by models of the other half
    of the sample, with each class weighed by its share of all labels. With no documents of a class the score is constant:
    the share of toxic labels, with one more of each class."""
    spark = docs.sparkSession
    marks = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    totals = dict.fromkeys((0, 1), 0) | {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    sample = None
    for kind in (0, 1):
        part = marks.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class)
        sample = part if sample is None else sample.union(part)
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = chosen.join(F.broadcast(sample), "doc_id")  # rows_per_class rows of each class at most
    rows = stash(chosen.select("text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int").alias("half")), "toxicity-sample")
    counted = map_arrow(rows, _count, "kind long, before long, word long, times long")
    grid = counted.groupBy("kind", "before", "word").agg(F.sum("times").alias("times")).toArrow()
    kind, times = (grid.column(c).to_numpy() for c in ("kind", "times"))
    before, word = (grid.column(c).to_numpy().view(np.uint64) for c in ("before", "word"))

    def of(half: int | None, toxic: int):
        own = (kind % 2 == toxic) & (half is None or kind // 2 == half)
        left, right, n = before[own], word[own], times[own]
        if half is not None:
            return left, right, n.astype(np.float64)
        _, at, inverse = np.unique(pair_hash(left, right), return_index=True, return_inverse=True)
        return left[at], right[at], np.bincount(inverse, weights=n, minlength=len(at))

    if any(not (own := kind % 2 == t).any() or len(np.unique(kind[own])) < 2 for t in (0, 1)):
        return Model(None, np.array([(totals[1] + 1) / (totals[0] + totals[1] + 2)]))
    halves = spark.sparkContext.broadcast([fit_ratios([of(1 - h, t) for t in (0, 1)]) for h in (0, 1)])

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in passes(whole):
                half = batch.column("half").to_numpy()
                x = np.where((half == 0)[:, None], *(features(batch.column("text"), r) for r in halves.value))
                yield pa.RecordBatch.from_arrays([*(pa.array(x[:, i]) for i in range(_FEATURES)), batch.column("toxic")], names=[*(f"x{i}" for i in range(_FEATURES)), "toxic"])

    got = map_arrow(rows, held, ", ".join(f"x{i} double" for i in range(_FEATURES)) + ", toxic int").toArrow()
    x = np.column_stack([got.column(f"x{i}").to_numpy() for i in range(_FEATURES)])
    y = got.column("toxic").to_numpy()
    used = np.maximum(np.bincount(y, minlength=2), 1)
    weight = np.array([totals[0] / used[0], totals[1] / used[1]])[y]
    weight = weight * len(y) / weight.sum()
    model = Model(fit_ratios([of(None, t) for t in (0, 1)]), _logistic(x, y, weight))
    halves.unpersist()
    return model


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name`` (0 to 1) added; null and empty texts are scored as texts of
    no words. Other columns pass through untouched; a column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c.lower() != name.lower()]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*rest).schema.fields)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in passes(whole):
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.score(batch.column("text")))], names=[*rest, name])

    return map_arrow(docs.select(*rest), scored, f"{fields}, `{name}` double")


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that score below ``threshold``, with their columns untouched, whatever their names. Repeated
    rows are scored alike, null and empty texts as texts of no words; texts of any length are read in windows; an
    empty table gives an empty one."""
    model, name = fit(docs, labels), free_name("toxicity_score", *docs.columns)
    return score(docs.withColumn("text", F.col("text").cast("string")), model, name).where(F.col(name) < threshold).select(*docs.columns)


def learnable(labels: DataFrame) -> DataFrame:
    """Labels of the folds that may be learned from."""
    return labels.where(fold(F.col("doc_id"), 5) != 0)


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = fit(docs, learnable(table(spark, folder, "labels")))
    return score(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
