"""Quality of texts by a generalised additive model with pairwise interactions.

Boosting goes round the features one at a time; each step fits a tree of three leaves to the residuals over one
feature's bins and adds it to that feature's lookup table. Pairs of features follow in the same way, on coarser
bins. What is left is a table a feature and a grid a pair, and a score is a sum of looked-up values.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import PUNCTUATION, SPACE, fold, free_name, map_arrow, pair_hash, passes, sums, table, texts, words
from tallyline.session import stash

#: Labelled rows per class that the model learns from at most, those of smallest hash.
ROWS_PER_CLASS = 8_000
#: Bins of a feature, and of each side of a pair; pairs kept; rounds over features and over pairs; step of a tree.
BINS, PAIR_BINS, PAIRS, ROUNDS, PAIR_ROUNDS, STEP = 48, 12, 12, 200, 100, 0.1
#: Weight of residuals that a leaf needs, and what is added to it against chance.
_LEAST, _RIDGE = 2.0, 1.0
#: Score from which a text counts as good.
THRESHOLD = 0.3

_WINDOW = 1 << 20
_KINDS = ("lower", "upper", "digit", "blank", "line", "stop", "comma", "exclaim", "bar", "symbol", "bracket", "beyond")
FEATURES = (
    "log_bytes", "log_words", "word_bytes", *(f"share_{k}" for k in _KINDS), "upper_of_letters", "distinct_words", "top_word",
    "repeated_pairs", "distinct_lines", "line_words", "terms_of_words",
)
_LINE = np.zeros(256, dtype=bool)
_LINE[[10, 13]] = True


def _kind_of_bytes() -> np.ndarray:
    out = np.full(256, _KINDS.index("symbol"), dtype=np.int64)
    for kind, members in {"stop": b".;:", "comma": b",'\"-", "exclaim": b"!?", "bar": b"|\\/", "bracket": b"()[]{}<>", "blank": b" \t", "line": b"\n\r"}.items():
        out[list(members)] = _KINDS.index(kind)
    for kind, (low, high) in {"lower": (97, 123), "upper": (65, 91), "digit": (48, 58), "beyond": (128, 256)}.items():
        out[low:high] = _KINDS.index(kind)
    return out


_KIND = _kind_of_bytes()


def _byte_counts(column: pa.Array) -> np.ndarray:
    """How many bytes of each kind every text has, a window of bytes at a time."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1, offset=column.offset * 8)
    low, high, width = int(offsets[0]), int(offsets[-1]), len(_KINDS)
    out = np.zeros((len(column), width))
    for start in range(low, high, _WINDOW):
        stop = min(start + _WINDOW, high)
        raw = np.frombuffer(column.buffers()[2], dtype=np.uint8, count=stop - start, offset=start)
        first = int(np.searchsorted(offsets, start, side="right")) - 1
        last = int(np.searchsorted(offsets, stop, side="left"))
        sizes = np.diff(np.clip(offsets[first : last + 1], start, stop))
        owner = np.repeat(np.arange(last - first), sizes)
        out[first:last] += np.bincount(owner * width + _KIND[raw], minlength=(last - first) * width).reshape(-1, width)
    return out


def _distinct(found, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: different words, and how often the most frequent one occurs."""
    key = pair_hash(found.owner.astype(np.uint64), found.hashes)
    _, first, times = np.unique(key, return_index=True, return_counts=True)
    most = np.zeros(count)
    np.maximum.at(most, found.owner[first], times)
    return np.bincount(found.owner[first], minlength=count).astype(float), most


def features(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` a text; null and empty texts are all zeros."""
    column = texts(column)
    kinds = _byte_counts(column)
    size = kinds.sum(axis=1)
    some = np.maximum(size, 1)
    spaced, lines, terms = words(column, SPACE), words(column, _LINE), words(column, PUNCTUATION)
    count, n, n_lines = len(column), np.maximum(spaced.sizes, 1), np.maximum(lines.sizes, 1)
    different, top = _distinct(spaced, count)
    different_lines, _ = _distinct(lines, count)
    # Word pairs that occur more than once in their text; the pair over a text's end belongs to none.
    within = spaced.owner[1:] == spaced.owner[:-1]
    owner = spaced.owner[1:][within]
    pair = pair_hash(pair_hash(owner.astype(np.uint64), spaced.hashes[:-1][within]), spaced.hashes[1:][within])
    _, inverse, times = np.unique(pair, return_inverse=True, return_counts=True)
    repeated = sums((times[inverse] > 1).astype(float), owner, count)
    letters = kinds[:, 0] + kinds[:, 1]
    return np.column_stack(
        [
            np.log1p(size), np.log1p(spaced.sizes), (size - kinds[:, _KINDS.index("blank")]) / n, kinds / some[:, None],
            kinds[:, 1] / np.maximum(letters, 1), different / n, top / n, repeated / n, different_lines / n_lines, spaced.sizes / n_lines, terms.sizes / n,
        ]
    )


@dataclass(frozen=True)
class Model:
    """Edges of bins, a table a feature, coarser edges, and a grid a pair of features; all sums are
    log-odds of good quality."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    grids: dict[tuple[int, int], np.ndarray]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for i, values in enumerate(self.tables):
            out += values[np.searchsorted(self.edges[i], x[:, i], side="right")]
        place = {i: np.searchsorted(self.coarse[i], x[:, i], side="right") for pair in self.grids for i in pair}
        for (a, b), values in self.grids.items():
            out += values[place[a], place[b]]
        return out

    def score(self, column: pa.Array) -> np.ndarray:
        if not self.tables:
            return np.full(len(column), _share(np.array([self.intercept]))[0])
        return _share(self.log_odds(features(column)))


def _share(log_odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(log_odds, -50, 50)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    """Bounds of bins with about equally many different values' rows; a value lies in one bin only."""
    return np.unique(np.quantile(x, np.arange(1, bins) / bins, method="higher"))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return np.where(h >= _LEAST, g * g / (h + _RIDGE), -np.inf)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """The best place to cut bins in two, and the gain over leaving them whole (0, 0 if none gains)."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(left_g):
        return 0, 0.0
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - g.sum() ** 2 / (h.sum() + _RIDGE)
    at = int(np.argmax(gains))
    return (at + 1, float(gains[at])) if gains[at] > 0 else (0, 0.0)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values of a tree with three leaves at most over a row of bins."""
    bounds = [0, len(g)]
    for _ in range(2):
        cuts = [(*_cut(g[a:b], h[a:b]), a) for a, b in zip(bounds, bounds[1:], strict=False)]
        at, gain, start = max(cuts, key=lambda c: c[1])
        if gain <= 0:
            break
        bounds = sorted([*bounds, start + at])
    out = np.zeros(len(g))
    for a, b in zip(bounds, bounds[1:], strict=False):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + _RIDGE)
    return out


def _grid_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values of a tree over a grid: one cut of the rows, then one of the columns on either side of it; and
    its gain. Both orders of the sides are tried."""
    best, values = 0.0, np.zeros_like(g)
    for turned in (False, True):
        gg, hh = (g.T, h.T) if turned else (g, h)
        for cut in range(1, len(gg)):
            gain, made = -gg.sum() ** 2 / (hh.sum() + _RIDGE), np.zeros_like(gg)
            for half in (slice(0, cut), slice(cut, None)):
                sg, sh = gg[half].sum(axis=0), hh[half].sum(axis=0)
                at, more = _cut(sg, sh)
                gain += more + sg.sum() ** 2 / (sh.sum() + _RIDGE)
                for side in (slice(0, at), slice(at, None)) if at else (slice(None),):
                    made[half, side] = sg[side].sum() / (sh[side].sum() + _RIDGE)
            if gain > best:
                best, values = gain, made.T if turned else made
    return values, best


def fit_tables(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Model:
    """Cyclic boosting on rows of features; ``y``: 0 or 1, both present."""
    share = (weight * y).sum() / weight.sum()
    intercept = float(np.log(share / (1 - share)))
    total = np.full(len(x), intercept)
    edges = [_edges(x[:, i], BINS) for i in range(x.shape[1])]
    place = [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]

    def residuals(at: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
        p = _share(total)
        return np.bincount(at, weight * (y - p), cells), np.bincount(at, weight * p * (1 - p), cells)

    for _ in range(ROUNDS):
        for i, values in enumerate(tables):
            step = STEP * _tree(*residuals(place[i], len(values)))
            values += step
            total += step[place[i]]
    coarse = [_edges(x[:, i], PAIR_BINS) for i in range(x.shape[1])]
    at = [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(coarse)]

    def grid(pair: tuple[int, int]) -> tuple[np.ndarray, tuple[int, int]]:
        shape = tuple(len(coarse[i]) + 1 for i in pair)
        return at[pair[0]] * shape[1] + at[pair[1]], shape

    def grown(pair: tuple[int, int]) -> tuple[np.ndarray, float]:
        cell, shape = grid(pair)
        return _grid_tree(*(r.reshape(shape) for r in residuals(cell, shape[0] * shape[1])))

    gains = {pair: grown(pair)[1] for pair in combinations(range(x.shape[1]), 2)}
    kept = sorted((p for p in gains if gains[p] > 0), key=lambda p: -gains[p])[:PAIRS]
    grids = {pair: np.zeros(grid(pair)[1]) for pair in kept}
    for _ in range(PAIR_ROUNDS):
        for pair in kept:
            step = STEP * grown(pair)[0]
            grids[pair] += step
            total += step.reshape(-1)[grid(pair)[0]]
    return Model(intercept, edges, tables, coarse, grids)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in passes(whole):
            x = pa.array(features(batch.column("text")).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("good"), x], names=["doc_id", "good", "x"])


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """Learn from labelled documents.

    ``labels`` (doc_id, quality): rows with a null in either are ignored, a document labelled both ways is not good.
    Per class, the ``rows_per_class`` documents of smallest hash are used, each weighed so that the classes keep their
    share of all labels; rows of ``docs`` that share a doc_id count once. This bounded sample is all that depends on the driver:
    features are computed in Spark's tasks, and the driver holds a few dozen numbers for each sampled row.
    With no documents of a class the score is constant: the share of good labels, with one more of each class."""
    marks = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.min("quality") > 0).cast("int").alias("good"))
    totals = dict.fromkeys((0, 1), 0) | {r["good"]: r["count"] for r in marks.groupBy("good").count().collect()}
    sample = None
    for kind in (0, 1):
        part = marks.where(F.col("good") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class)
        sample = part if sample is None else sample.union(part)
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = chosen.join(F.broadcast(stash(sample, "quality-sample")), "doc_id")  # rows_per_class rows of each class at most
    rows = map_arrow(chosen.select("doc_id", "good", "text"), _featured, "doc_id long, good int, x array<double>")
    got = rows.groupBy("doc_id").agg(F.min(F.struct("good", "x")).alias("r")).select("r.good", "r.x").toArrow()
    y = got.column("good").to_numpy()
    if len(np.unique(y)) < 2:
        share = (totals[1] + 1) / (totals[0] + totals[1] + 2)
        return Model(float(np.log(share / (1 - share))), [], [], [], {})
    used = np.bincount(y, minlength=2)
    weight = np.array([totals[0] / used[0], totals[1] / used[1]])[y]
    x = got.column("x").combine_chunks().flatten().to_numpy().reshape(len(y), -1)
    order = np.lexsort((*x.T, y))  # sums in a fixed order give the same tables every time
    return fit_tables(x[order], y[order], (weight * len(y) / weight.sum())[order])


def score(docs: DataFrame, model: Model, name: str = "quality_score") -> DataFrame:
    """``docs`` with all its columns and a score from 0 to 1; null and empty texts are scored as texts of no
    words. Texts of any length are read in windows. If a column has that name in any case, the new one gets
    underscores after it."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    added, text = free_name(name, *names), names.index("text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in passes(whole):
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.score(batch.column(text)))], names=[*names, added])

    return map_arrow(docs, scored, f"{fields}, `{added}` double")


def learnable(labels: DataFrame) -> DataFrame:
    """Labels of the folds that may be learned from."""
    return labels.where(fold(F.col("doc_id"), 5) != 0)


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = fit(docs, learnable(table(spark, folder, "labels")))
    return score(docs, model, "score").select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
