"""Language identification with error-correcting output codes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import fold, map_arrow, passes, table, texts
from tallyline.session import stash

#: Labelled rows that the classifiers learn from, about: the same share of it for each language,
#: chosen by hash.
SAMPLE_ROWS = 4_000
#: Byte n-grams are hashed to so many features for each length.
BUCKETS, LENGTHS = 1 << 10, (1, 2, 3, 4)
#: A prediction counts as ambiguous if the runner-up's loss is within this share of the winner's.
AMBIGUOUS = 0.25


def codewords(languages: int, seed: int = 7) -> np.ndarray:
    """One row of +1/-1 for every language, far apart from each other. Up to seven languages get the
    exhaustive code (every split of them is a bit); more get the best of many random codes."""
    if languages <= 1:
        return np.ones((languages, 1))
    if languages <= 7:
        splits = np.arange(2 ** (languages - 1) - 1)
        return np.array([[1.0] * len(splits)] + [np.where(splits >> i & 1, 1.0, -1.0) for i in range(languages - 1)])
    draw = np.random.default_rng(seed)
    width, best, most = int(np.ceil(10 * np.log2(languages))), None, -1.0
    for _ in range(300):
        code = draw.choice([-1.0, 1.0], (languages, width))
        apart = (width - (code @ code.T - np.eye(languages) * 2 * width).max()) / 2
        if apart > most and (np.abs(code.sum(axis=0)) < languages).all():
            best, most = code, apart
    return best


_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += np.uint64(32)
_FOLD[[9, 10, 11, 12, 13]] = 32
#: Digits and ASCII punctuation say nothing of the language.
_FOLD[[i for i in range(33, 128) if not chr(i).isalpha()]] = 32


def features(column: pa.Array) -> np.ndarray:
    """Per text, the share of each hashed n-gram of its lower-cased UTF-8 bytes, square-rooted;
    n-grams do not cross texts."""
    column = texts(column)
    count = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=count + 1, offset=column.offset * 8)
    low, high = int(offsets[0]), int(offsets[-1])
    width = len(LENGTHS) * BUCKETS
    out = np.zeros((count, width), dtype=np.float32)
    if high == low:
        return out
    raw = _FOLD[np.frombuffer(column.buffers()[2], dtype=np.uint8, count=high - low, offset=low)]
    owner = np.repeat(np.arange(count), np.diff(offsets))
    bits = BUCKETS.bit_length() - 1
    for k, size in enumerate(LENGTHS):
        if len(raw) < size:
            continue
        gram = raw[: len(raw) - size + 1].copy()
        for i in range(1, size):
            gram = gram << np.uint64(8) | raw[i : len(raw) - size + 1 + i]
        slot = (gram * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
        own = owner[: len(gram)]
        whole = own == owner[size - 1 :]
        place = own[whole] * BUCKETS + slot[whole].astype(np.int64)
        tally = np.bincount(place, minlength=count * BUCKETS).reshape(count, BUCKETS)
        total = np.maximum(tally.sum(axis=1, keepdims=True), 1)
        out[:, k * BUCKETS : (k + 1) * BUCKETS] = np.sqrt(tally / total)
    return out


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    #: How much each bit counts: less the more often its classifier erred.
    trust: np.ndarray

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Per text and language: the trust-weighted logistic loss of its codeword."""
        margin = x @ self.weights + self.bias
        return np.logaddexp(0, -margin[:, None, :] * self.code[None]) @ self.trust


def _letters(column: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(texts(column), r"\pL").to_numpy(zero_copy_only=False)


def _train(x: np.ndarray, y: np.ndarray, languages: list[str], rounds: int = 60) -> Model:
    """A logistic classifier for each bit, all at once, by accelerated gradient steps."""
    code = codewords(len(languages))
    target = code[y]
    share = np.bincount(y, minlength=len(languages))
    weight = (1 / np.maximum(share, 1))[y]
    weight = (weight / weight.sum())[:, None].astype(np.float32)
    w = np.zeros((x.shape[1], code.shape[1]), dtype=np.float32)
    b = np.zeros(code.shape[1], dtype=np.float32)
    look, last_w, last_b, rate, ridge = w, w, b, 4.0 / len(LENGTHS), 1e-5
    look_b = b
    for i in range(rounds):
        slope = -target / (1 + np.exp(np.clip(target * (x @ look + look_b), -30, 30))) * weight
        w = look - rate * (x.T @ slope + ridge * look)
        b = look_b - rate * slope.sum(axis=0)
        speed = i / (i + 3)
        look, look_b = w + speed * (w - last_w), b + speed * (b - last_b)
        last_w, last_b = w, b
    wrong = ((target * (x @ w + b)) <= 0).T @ weight[:, 0]
    trust = np.log((1 - wrong + 1e-3) / (wrong + 1e-3))
    return Model(languages, code, w.astype(np.float32), b, np.maximum(trust, 1e-3) / np.maximum(trust, 1e-3).sum())


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from ``docs`` (doc_id, text, lang): rows with a null language, or without a letter, are
    ignored. A bounded sample, about ``sample_rows`` rows in equal parts of each language, one row of it at least in the mean,
    goes through the features in Spark; the classifiers are fitted on it. Of repeated rows
    each counts. Without labelled rows the model knows no language."""
    spark = docs.sparkSession
    known = docs.where("lang is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "lang").where(F.col("text").rlike(r"\p{L}"))
    shares = known.groupBy("lang").count().collect()  # a row a language
    languages = sorted(r["lang"] for r in shares)
    if not languages:
        return Model([], np.ones((0, 1)), np.zeros((len(LENGTHS) * BUCKETS, 1), np.float32), np.zeros(1), np.ones(1))
    counts = {r["lang"]: r["count"] for r in shares}
    # A share of each language by hash: about so many rows, whatever there are.
    rows_per_language = max(sample_rows / len(languages), 1.0)
    limits = F.create_map(*[F.lit(v) for lang in languages for v in (lang, min(1.0, rows_per_language / counts[lang]))])
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 20)) / F.lit(float(1 << 20)) < limits[F.col("lang")])
    index = F.create_map(*[F.lit(v) for i, lang in enumerate(languages) for v in (lang, i)])
    rows = stash(chosen.select("text", index[F.col("lang")].alias("y")), "language-sample")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in passes(whole, limit=1 << 20):
                packed = [v.astype(np.float16).tobytes() for v in features(batch.column("text"))]
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column("y")], names=["x", "y"])

    got = map_arrow(rows, vectors, "x binary, y int").toArrow()
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float16).reshape(got.num_rows, -1).astype(np.float32)
    return _train(x, got.column("y").to_numpy(), languages)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1: the winner's weight among all languages) and
    ``ambiguous`` (the runner-up comes close) added.

    A text that is null or has no letter is ``und`` with score 0 and ambiguous, as is every text if
    the model knows no language. Ties go to the language that sorts first. Texts are whole; nothing
    is shuffled; other columns and repeated rows stay; columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "ambiguous")]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*rest).schema.fields)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.languages, "und"], dtype=object)
        for whole in batches:
            for batch in passes(whole, limit=1 << 20):
                count = batch.num_rows
                best, score, close = np.full(count, len(m.languages)), np.zeros(count), np.ones(count, bool)
                if m.languages:
                    loss = m.losses(features(batch.column("text")))
                    ranked = np.sort(loss, axis=1)
                    weight = np.exp(-(loss - ranked[:, :1]) * m.code.shape[1])
                    some = _letters(batch.column("text"))
                    best = np.where(some, loss.argmin(axis=1), best)
                    score = np.where(some, 1 / weight.sum(axis=1), 0.0)
                    second = ranked[:, 1] if loss.shape[1] > 1 else np.full(count, np.inf)
                    close = ~some | (second <= ranked[:, 0] * (1 + AMBIGUOUS) + 1e-9)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(names[best], pa.string()), pa.array(score), pa.array(close)], names=[*rest, "lang_pred", "score", "ambiguous"]
                )

    return map_arrow(docs.select(*rest), predicted, f"{fields}, lang_pred string, score double, ambiguous boolean")


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = fit(docs.where(~held_out).select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")
