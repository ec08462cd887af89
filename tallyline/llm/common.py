"""Reading tables, bounded Arrow batches and a vectorised word splitter."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one numpy pass works on; bounds the temporaries of a task.
PASS_BYTES = 4 << 20


_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application: Spark serves the archive from the
    driver, so nothing has to be installed or shared beforehand."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    folder = _shipped[context.applicationId] = tempfile.TemporaryDirectory(prefix="tallyline-code-")
    package = Path(__file__).resolve().parent.parent
    with zipfile.ZipFile(f"{folder.name}/tallyline-code.zip", "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(f"{folder.name}/tallyline-code.zip")


def map_arrow(rows: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors."""
    ship(rows.sparkSession)
    return rows.mapInArrow(function, schema)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(name: str, *taken: str) -> str:
    """``name``, with as many underscores after it as it takes to clash with none of ``taken`` in any case."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name


def fold(key: Column, folds: int) -> Column:
    """The fold of a row: crc32 of its id as text, modulo ``folds``; null ids are in fold 0."""
    return F.coalesce(F.crc32(key.cast("string")) % folds, F.lit(0))


def texts(column: pa.Array) -> pa.Array:
    """Strings without nulls: a null text counts as empty."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def passes(batch: pa.RecordBatch, column: str = "text", limit: int = PASS_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``limit`` bytes of text each; one row at least."""
    if batch.num_rows == 0:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """An order-sensitive hash of two 64-bit hashes."""
    return _mix(left * np.uint64(0x9E3779B97F4A7C15) + (right ^ np.uint64(0xC2B2AE3D27D4EB4F)))


_TABLE = np.random.default_rng(20_240_607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x5851F42D4C957F2D)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def separators(pattern: str) -> np.ndarray:
    """Which byte values separate words: ``space`` (ASCII white space) or ``punctuation``
    (every ASCII byte that is neither a letter nor a digit; bytes of other scripts are letters)."""
    out = np.zeros(256, dtype=bool)
    if pattern == "space":
        out[[9, 10, 11, 12, 13, 32]] = True
    else:
        out[:128] = [not chr(i).isalnum() for i in range(128)]
    return out


SPACE, PUNCTUATION = separators("space"), separators("punctuation")


@dataclass(frozen=True)
class Words:
    """The words of several texts: their 64-bit hashes, the text each belongs to, and how many
    each text has."""

    hashes: np.ndarray
    owner: np.ndarray
    sizes: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """Where each text's words begin, and the total at the end."""
        return np.concatenate([[0], np.cumsum(self.sizes)])


#: Text bytes that are split at a time; temporaries take some forty times as much.
_SPLIT_BYTES = 1 << 18


def words(column: pa.Array, separator: np.ndarray = SPACE) -> Words:
    """Split texts, lower-casing A-Z only, and hash every word (64 bits: two different words in
    a vocabulary of a billion share one with a probability of about three in a hundred).

    Works on windows of bytes, whatever the lengths of the texts; a word that a window cuts goes on in the
    next one, since its hash is made from a sum over its bytes."""
    column = texts(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1, offset=column.offset * 8)
    count, low, high = len(column), int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8, count=high - low, offset=low) if high > low else np.zeros(0, np.uint8)
    edges = offsets - low
    found = [_Part(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), False)]
    for start in range(0, len(data), _SPLIT_BYTES):
        part = _split(data, edges, start, min(start + _SPLIT_BYTES, len(data)), separator)
        if part.continues:
            last = next(f for f in reversed(found) if len(f.sums))
            last.sums[-1:] += part.sums[:1] * np.uint64(pow(int(_STEP), int(last.lengths[-1]), 1 << 64))
            last.lengths[-1:] += part.lengths[:1]
            part = _Part(part.sums[1:], part.lengths[1:], part.owner[1:], False)
        found.append(part)
    owner = np.concatenate([f.owner for f in found])
    return Words(_mix(np.concatenate([f.sums for f in found])), owner, np.bincount(owner, minlength=count))


@dataclass(frozen=True)
class _Part:
    """Words of one window: sums over their bytes, lengths, the texts they belong to, and whether the first
    one goes on from the window before."""

    sums: np.ndarray
    lengths: np.ndarray
    owner: np.ndarray
    continues: bool


def _split(data: np.ndarray, edges: np.ndarray, low: int, high: int, separator: np.ndarray) -> _Part:
    raw = _LOWER[data[low:high]]
    inside = ~separator[raw]
    borders = edges[np.searchsorted(edges, low) : np.searchsorted(edges, high)] - low
    follows = np.zeros(len(raw), dtype=bool)
    follows[1:] = inside[:-1]
    follows[borders] = False
    place = np.flatnonzero(inside)
    starts = np.flatnonzero(inside & ~follows)
    if not len(starts):
        return _Part(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), False)
    first = np.searchsorted(place, starts)
    lengths = np.diff(first, append=len(place))
    within = np.arange(len(place)) - np.repeat(first, lengths)
    powers = np.full(int(lengths.max()), _STEP, dtype=np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    sums_ = np.add.reduceat(_TABLE[raw[place]] * powers[within], first)
    owner = np.searchsorted(edges[1:], starts + low, side="right")
    goes_on = bool(low and inside[0] and not separator[data[low - 1]] and not (len(borders) and borders[0] == 0))
    return _Part(sums_, lengths, owner, goes_on)


def hash_of(word: str) -> int:
    """The hash that ``words`` gives this single word."""
    return int(words(pa.array([word]), np.zeros(256, dtype=bool)).hashes[0])


def sums(values: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    return np.bincount(owner, weights=values, minlength=count)


class Lookup:
    """Values by 64-bit hash, for whole arrays of hashes at once; unknown ones get ``default``.

    Keys are sorted, and an index over their leading bits, about one entry a key, says where to
    begin; so a lookup touches two or three places and a table takes little more than its content."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, default: float = 0.0):
        keys = keys.astype(np.uint64, copy=False)
        order = np.argsort(keys)
        self.keys, self.values, self.default = keys[order], values[order], default
        bits = max(1, int(len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        counts = np.bincount((self.keys >> self.shift).astype(np.int64), minlength=1 << bits)
        self.begin = np.concatenate([[0], np.cumsum(counts)]).astype(np.uint32 if len(keys) < 2**32 else np.uint64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), self.default, dtype=self.values.dtype)
        slot = keys >> self.shift
        at, end = self.begin[slot].astype(np.int64), self.begin[slot + np.uint64(1)].astype(np.int64)
        open_ = np.flatnonzero(at < end)
        at, end, wanted = at[open_], end[open_], keys[open_]
        while len(open_):
            there = self.keys[at]
            hit = there == wanted
            out[open_[hit]] = self.values[at[hit]]
            at = at + 1
            go = ~hit & (there < wanted) & (at < end)
            open_, at, end, wanted = open_[go], at[go], end[go], wanted[go]
        return out
