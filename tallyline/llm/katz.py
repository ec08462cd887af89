"""Language-model scores from a Katz backoff model of word pairs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import SPACE, Lookup, fold, map_arrow, pair_hash, passes, table, words
from tallyline.session import stash

#: Counts up to this are discounted by Good and Turing; larger ones keep all but a millionth, so that
#: every history has something left to back off with.
CUT = 5
KEPT = 1 - 1e-6
#: The end of a text, a token, and its start, a history only.
END, START = np.uint64(0x1D4F_0A3B_77C2_9E65), np.uint64(0x62E9_B81C_05D7_43AF)
#: Text bytes of a block, and tokens of a part of the model, about.
BLOCK_BYTES, PART_TOKENS = 8 << 20, 2_000_000
#: Frequent words of a sample of documents: their two-byte codes shorten what is sent, and those
#: with more than an eighth of a part are split by history. Neither changes a result.
CODED, SAMPLE_DOCS = 65_535, 20_000


def _pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays as one compressed byte string, equal bytes of neighbouring values side by side."""
    press, out = zstandard.ZstdCompressor(level=1), []
    for a in arrays:
        body = press.compress(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes()) if len(a) else b""
        out.append(np.array([len(a), len(body)], dtype="<i8").tobytes() + a.dtype.str.encode().ljust(4) + body)
    return b"".join(out)


def _unpack(data: bytes) -> list[np.ndarray]:
    press, out, at = zstandard.ZstdDecompressor(), [], 0
    while at < len(data):
        count, size = np.frombuffer(data, dtype="<i8", count=2, offset=at).tolist()
        kind = np.dtype(data[at + 16 : at + 20].decode().strip())
        body = press.decompress(data[at + 20 : at + 20 + size], max_output_size=count * kind.itemsize) if count else b""
        out.append(np.frombuffer(body, dtype=np.uint8).reshape(kind.itemsize, -1).T.copy().view(kind).ravel() if count else np.zeros(0, kind))
        at += 20 + size
    return out


def _slim(values: np.ndarray) -> np.ndarray:
    """Non-negative integers in as few bytes as their largest takes."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Histories, tokens (an end after each text's words), the text of each, and tokens per text."""
    found = words(column, SPACE)
    sizes = found.sizes + 1
    ends = np.cumsum(sizes) - 1
    token = np.full(int(sizes.sum()), END, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    inner = np.ones(len(token), dtype=bool)
    inner[ends] = False
    token[inner] = found.hashes
    history = np.empty_like(token)
    history[1:] = token[:-1]
    history[ends - sizes + 1] = START
    return history, token, owner, sizes


@dataclass(frozen=True)
class Layout:
    """How the model is cut: its parts, the words with codes, and the counts of those that are split."""

    parts: int
    coded: np.ndarray
    split: Lookup

    def part(self, history: np.ndarray, token: np.ndarray) -> np.ndarray:
        own = np.where(self.split.get(token) >= 0, pair_hash(token, history), token)
        return ((own >> np.uint64(20)) % np.uint64(self.parts)).astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch], only: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Words and their counts, a row for each batch and word."""
    for whole in batches:
        for batch in passes(whole, limit=BLOCK_BYTES):
            token = _tokens(batch.column("text"))[1]
            if only is not None:
                token = token[np.isin(token, only)]
            kinds, times = np.unique(token, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(times)], names=["word", "n"])


def layout(docs: DataFrame) -> Layout:
    """Parts for the number of tokens that a sample of documents suggests, and the sample's most
    frequent words. Words that would fill much of a part are counted exactly over the training texts."""
    rows = max(1, docs.count())
    share = min(1.0, SAMPLE_DOCS / rows)
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("text")
    counted = stash(map_arrow(sample, _counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "katz-sample")
    tokens = (counted.agg(F.sum("n")).first()[0] or 0) / share
    wanted = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = int(max(1, np.ceil(tokens / PART_TOKENS), min(wanted, np.ceil(tokens / (PART_TOKENS / 4)))))
    top = counted.orderBy(F.desc("n"), "word").limit(CODED).toArrow()
    coded, often = top.column("word").to_numpy().view(np.uint64), top.column("n").to_numpy()
    large = coded[often / share > tokens / parts / 8]
    exact = map_arrow(docs.where("train").select("text"), lambda batches: _counted(batches, large), "word long, n long")
    sums = exact.groupBy("word").agg(F.sum("n").alias("n")).toArrow()
    known = dict(zip(sums.column("word").to_numpy().view(np.uint64).tolist(), sums.column("n").to_pylist(), strict=True))
    return Layout(parts, np.sort(coded), Lookup(large, np.array([known.get(w, 0) for w in large.tolist()], dtype=np.int64), -1))


def _send(batches: Iterator[pa.RecordBatch], plan: Layout) -> Iterator[pa.RecordBatch]:
    """Of each block of documents: for each part of the model a row with its word pairs and where they
    occur; and a row with the documents themselves, under a negative part."""
    block = TaskContext.get().partitionId() << 32
    for whole in batches:
        for batch in passes(whole, limit=BLOCK_BYTES):
            history, token, owner, sizes = _tokens(batch.column("text"))
            ids, train = batch.column("doc_id"), batch.column("train").to_numpy(zero_copy_only=False)
            part = plan.part(history, token)
            order = np.lexsort((history, token, part))
            history, token, owner, part = history[order], token[order], owner[order], part[order]
            rows = [(-1 - block % plan.parts, _pack([ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8), train.astype(np.uint8), sizes]))]
            bounds = np.searchsorted(part, np.arange(plan.parts + 1))
            for p in range(plan.parts):
                a, b = bounds[p], bounds[p + 1]
                if a == b:
                    continue
                w, v = token[a:b], history[a:b]
                new_w = np.concatenate([[True], w[1:] != w[:-1]])
                pair = np.flatnonzero(new_w | np.concatenate([[True], v[1:] != v[:-1]]))
                first_v = v[pair]
                at = np.minimum(np.searchsorted(plan.coded, first_v), max(len(plan.coded) - 1, 0))
                short = plan.coded[at] == first_v if len(plan.coded) else np.zeros(len(pair), bool)
                per_w = np.diff(np.append(np.searchsorted(pair, np.flatnonzero(new_w)), len(pair)))
                rows.append((p, _pack([
                    w[new_w], _slim(per_w), short.astype(np.uint8), at[short].astype(np.uint16), first_v[~short],
                    _slim(np.diff(np.append(pair, b - a))), _slim(owner[a:b]), train.astype(np.uint8),
                ])))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array(np.full(len(rows), block)), pa.array([r[1] for r in rows], pa.binary())], names=["part", "block", "data"])
            block += 1


#: What a part adds up for each document: float sums, then counts.
_SUMS = ("base", "seen_log", "history_log", "unseen_log")
_COUNTS = ("known", *(f"seen{r}" for r in range(1, CUT + 1)), "unseen", *(f"lower{r}" for r in range(CUT + 1)))


def _count(rows: list[tuple[int, bytes]], plan: Layout) -> list[tuple[str, int, bytes]]:
    """Count one part of the model and look its pairs up again, for every block."""
    token, history, times, owner, train = [], [], [], [], []
    offset, starts = 0, []
    for number, data in rows:
        w, per_w, short, code, rare, n, docs, flags = _unpack(data)
        v = np.empty(len(short), dtype=np.uint64)
        v[short == 1], v[short == 0] = plan.coded[code], rare
        token.append(np.repeat(w, per_w))
        history.append(v)
        times.append(n.astype(np.int64))
        owner.append(docs.astype(np.int64) + offset)
        train.append(flags)
        starts.append((number, offset, len(flags)))
        offset += len(flags)
    w, v, n, owner, train = (np.concatenate(x) for x in (token, history, times, owner, train))
    del token, history, times
    learn = np.add.reduceat(train[owner].astype(np.int64), np.concatenate([[0], np.cumsum(n)[:-1]]))
    _, first, inverse = np.unique(pair_hash(w, v), return_index=True, return_inverse=True)
    r = np.bincount(inverse, weights=learn).astype(np.int64)
    kinds, place = np.unique(w, return_inverse=True)
    split = plan.split.get(kinds)
    c = np.where(split >= 0, split, np.bincount(place, weights=learn).astype(np.int64))
    out = [("tally", 0, _pack(_tally(kinds, c, split, r)))]
    # Pairs that training has, by history: how often each small count, and the sum of the large ones; of
    # the pair itself, and of the word's own count.
    types = r > 0
    tv, tr, tc = v[first][types], r[types], c[place[first]][types]
    keys, group = np.unique(tv, return_inverse=True)
    if len(keys):
        table_ = [keys]
        for count in (tr, tc):
            table_ += [_slim(np.bincount(group[count == i], minlength=len(keys))) for i in range(1, CUT + 1)]
            table_.append(_slim(np.bincount(group, weights=np.where(count > CUT, count, 0), minlength=len(keys)).astype(np.int64)))
        out.append(("history", 0, _pack([*table_, _slim(np.bincount(group[tr > CUT], minlength=len(keys))), _slim(np.bincount(group[tc > CUT], minlength=len(keys)))])))
    # Of each pair of a block, then of each place where it occurs; one field at a time, for memory.
    R, C, total = r[inverse], c[place], offset
    missed, log_c = R == 0, np.log10(np.maximum(c[place], 1))
    fields = [
        np.bincount(owner, weights=np.repeat(value, n), minlength=total)
        for value in (
            np.log10(C + 1.0), np.where(R > CUT, np.log10(np.maximum(R, 1)), 0.0),
            np.where(w != END, log_c, 0.0), np.where(missed & (C > CUT), log_c, 0.0),
        )
    ]
    for mask in (C > 0, *(R == i for i in range(1, CUT + 1)), missed, *(missed & (C == i) for i in range(CUT + 1))):
        fields.append(np.bincount(owner[np.repeat(mask, n)], minlength=total))
    there = np.bincount(owner, minlength=total) > 0
    occurs = np.repeat(np.arange(len(w), dtype=np.int32 if len(w) < 2**31 else np.int64), n)
    away = np.flatnonzero(missed[occurs])
    away = away[np.argsort(owner[away], kind="stable")]
    cuts = np.searchsorted(owner[away], [s[1] for s in starts] + [total])
    for i, (number, begin, size) in enumerate(starts):
        docs = np.flatnonzero(there[begin : begin + size])
        part = [f[begin : begin + size][docs] for f in fields]
        out.append(("sums", number, _pack([_slim(docs), *part[: len(_SUMS)], *map(_slim, part[len(_SUMS) :])])))
        own = away[cuts[i] : cuts[i + 1]]
        if len(own):
            out.append(("unseen", number, _pack([v[occurs[own]], _slim(owner[own] - begin)])))
    return out


def _tally(kinds: np.ndarray, c: np.ndarray, split: np.ndarray, r: np.ndarray) -> list[np.ndarray]:
    """Words and pairs of small counts, all words, and all tokens; words that are split are left out,
    and counted from the layout."""
    own = c[(split < 0) & (c > 0)]
    small = [np.bincount(x[(x > 0) & (x <= CUT + 1)], minlength=CUT + 2)[: CUT + 2] for x in (own, r)]
    return [*small, np.array([len(own), own.sum(), c[(kinds == END) & (split < 0)].sum()], dtype=np.int64)]


def _parts(batches: Iterator[pa.RecordBatch], plan: Layout) -> Iterator[pa.RecordBatch]:
    """Every part in turn; rows come sorted by part."""

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)

    for part, group in groupby(rows(), key=lambda x: x[0]):
        if part < 0:
            found = [("docs", block, data) for _, block, data in group]
        else:
            found = _count([(block, data) for _, block, data in group], plan)
        yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found]), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.binary())], names=["kind", "block", "data"])


def discounts(n: np.ndarray) -> np.ndarray:
    """Good-Turing discount ratios of counts 1 to ``CUT``, from how many events have counts 1 to
    ``CUT`` + 1, in Katz's form, which leaves larger counts alone. A corpus with copies has uneven counts of
    counts; if they give no ratios between 0 and 1, a straight line through their logarithms takes their
    place (Gale's simple Good-Turing), and half a count is taken off where that fails too."""
    r = np.arange(1, CUT + 1)
    for smooth in (False, True):
        m = n[: CUT + 2].astype(np.float64)
        if not (m[1:] > 0).all():
            break
        if smooth:
            every = np.arange(1, CUT + 2)
            slope, start = np.polyfit(np.log(every), np.log(m[1:]), 1)
            m[1:] = np.exp(start + slope * np.log(every))
        tail = (CUT + 1) * m[CUT + 1] / m[1]
        if tail < 1:
            d = ((r + 1) * m[r + 1] / (r * m[r]) - tail) / (1 - tail)
            if ((d > 0) & (d < 1)).all():
                return d
    return (r - 0.5) / r


@dataclass(frozen=True)
class Constants:
    """What the whole corpus settles: tokens, words, training texts, discounts, and the unknown word."""

    tokens: int
    words: int
    texts: int
    word_discount: np.ndarray
    pair_discount: np.ndarray
    unknown: float


def constants(tallies: list[list[np.ndarray]], plan: Layout) -> Constants:
    split = plan.split.values[plan.split.values > 0]
    word_n = sum((t[0] for t in tallies), np.zeros(CUT + 2, np.int64)) + np.bincount(split[split <= CUT + 1], minlength=CUT + 2)[: CUT + 2]
    pair_n = sum((t[1] for t in tallies), np.zeros(CUT + 2, np.int64))
    ends = max(0, int(plan.split.get(np.array([END]))[0]))
    kinds, tokens, texts = (sum((t[2] for t in tallies), np.zeros(3, np.int64)) + np.array([len(split), split.sum(), ends], dtype=np.int64)).tolist()
    d = discounts(word_n)
    r = np.arange(1, CUT + 1)
    small = float((word_n[r] * r).sum())
    mass = ((d * r * word_n[r]).sum() + KEPT * (tokens - small)) / max(tokens, 1)
    return Constants(tokens, kinds, texts, d, discounts(pair_n), 1 - mass if tokens else 1.0)


@dataclass(frozen=True)
class Scored:
    """Scores, and the model's tables, stored in the shared folder: ``histories`` (history, total,
    log10 of total times backoff weight) and the packed parts they come from."""

    scores: DataFrame
    histories: DataFrame
    parts: DataFrame
    constants: Constants


def score(docs: DataFrame) -> Scored:
    """Learn from the texts of ``docs`` (doc_id, text, train) that are marked, and score all of them.

    The model: a pair seen r times after a history seen c times has probability d(r) r / c, with d(r)
    by Good and Turing up to r = 5. Any other word has a(history) times its own probability, which is d(c) c / N,
    and the rest of all words' for an unknown word. a(history) is what the pairs leave over, divided by what
    the words that were not seen after it add up to, so all probabilities after a history add up to one
    exactly. A history that training does not have passes a word on at a = 1. A text is its
    words and an end; its history at the start is a mark.

    How it runs: the model is cut by word into parts. Every block of documents sends each part one packed
    row with its pairs and the documents they occur in; the part counts the pairs and words, which are complete
    there, and looks the same pairs up. What does not depend on the history is added up per document at once.
    Only pairs that training lacks, which only other texts have, are sent on to their histories for the backoff
    weights. Constants of the corpus (counts of counts) enter last, so the text is read once. Very frequent
    words are split over all parts by history.

    Null texts count as empty and score as the end alone; a repeated row is counted and scored as often as it
    comes; null ids stay null. Without training texts every score is 0, that of an unknown word. An empty table gives an empty result."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce("train", F.lit(False)).alias("train"))
    plan = layout(rows)
    shared = spark.sparkContext.broadcast(plan)  # CODED words at most
    sent = map_arrow(rows, lambda batches: _send(batches, shared.value), "part long, block long, data binary")
    dealt = sent.repartition(2 * plan.parts, "part").sortWithinPartitions("part", "block")
    parts = stash(map_arrow(dealt, lambda batches: _parts(batches, shared.value), "kind string, block long, data binary"), "katz-parts")
    tallies = [_unpack(bytes(r["data"])) for r in parts.where("kind = 'tally'").select("data").collect()]  # a row a part
    known = constants(tallies, plan)
    histories = stash(_histories(parts, known), "katz-histories")

    def away(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                v, doc = _unpack(data)
                yield pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)), pa.array(np.full(len(v), block)), pa.array(doc.astype(np.int64))], names=["history", "block", "doc"])

    missed = map_arrow(parts.where("kind = 'unseen'").select("block", "data"), away, "history long, block long, doc long")
    backed = missed.join(histories.select("history", "backoff_log"), "history").groupBy("block", "doc").agg(F.sum("backoff_log").alias("backoff_log"))
    summed = _documents(parts, known)
    return Scored(summed.join(backed, ["block", "doc"], "left").select(
        "doc_id", "train", "n_tokens", "n_known", "base_score", (F.col("score") + F.coalesce("backoff_log", F.lit(0.0))).alias("score")
    ), histories, parts, known)


def _histories(parts: DataFrame, known: Constants) -> DataFrame:
    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.arange(1, CUT + 1)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                keys, *rest = _unpack(data)
                pair, word = np.array(rest[:CUT], dtype=np.float64).T, np.array(rest[CUT + 1 : 2 * CUT + 1], dtype=np.float64).T
                pair_big, word_big = rest[CUT].astype(np.float64), rest[2 * CUT + 1].astype(np.float64)
                total = pair @ r + pair_big
                left = pair @ (r * (1 - known.pair_discount)) + pair_big * (1 - KEPT)
                lower = (word @ (r * known.word_discount) + word_big * KEPT) / max(known.tokens, 1)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *(pa.array(x) for x in (total, left, lower))], names=["history", "total", "left", "lower"])

    each = map_arrow(parts.where("kind = 'history'").select("data"), opened, "history long, total double, left double, lower double")
    summed = each.groupBy("history").agg(*(F.sum(c).alias(c) for c in ("total", "left", "lower")))
    # An unseen pair was counted as if seen: the logarithm of the total is taken back, that of the weight added.
    weight = (F.col("left") / F.col("total")) / F.greatest(1 - F.col("lower"), F.lit(known.unknown))
    return summed.select("history", "total", weight.alias("backoff"), (F.log10("total") + F.log10(weight)).alias("backoff_log"))


def _documents(parts: DataFrame, known: Constants) -> DataFrame:
    """Sums of every document over all parts, with the constants put in."""
    fields = [*_SUMS, *_COUNTS]

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)

        for block, group in groupby(rows(), key=lambda x: x[0]):
            sums, ids, missing, train, sizes = None, None, None, None, None
            for _, kind, data in group:  # the documents sort before the sums
                if kind == "docs":
                    ids, missing, train, sizes = _unpack(data)
                    sums = np.zeros((len(fields), len(ids)))
                else:
                    docs, *part = _unpack(data)
                    for i, f in enumerate(part):
                        sums[i, docs] += f
            s = dict(zip(fields, sums, strict=True))
            r = np.arange(1, CUT + 1)
            n = sizes.astype(np.float64)
            total = max(known.tokens, 1)
            seen_small = sum(s[f"seen{i}"] for i in r)
            seen_big = n - s["unseen"] - seen_small
            lower_small = sum(s[f"lower{i}"] for i in range(CUT + 1))
            score_ = s["seen_log"] - s["history_log"] + seen_big * np.log10(KEPT) - np.log10(max(known.texts, 1))
            score_ += sum(s[f"seen{i}"] * np.log10(known.pair_discount[i - 1] * i) for i in r)
            score_ += s["lower0"] * np.log10(known.unknown) + sum(s[f"lower{i}"] * np.log10(known.word_discount[i - 1] * i / total) for i in r)
            score_ += s["unseen_log"] + (s["unseen"] - lower_small) * (np.log10(KEPT) - np.log10(total))
            base = s["base"] - n * np.log10(known.tokens + known.words + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), block)), pa.array(np.arange(len(ids))), pa.array(ids, mask=missing == 1), pa.array(train == 1),
                    pa.array(sizes.astype(np.int64)), pa.array(s["known"].astype(np.int64)), pa.array(base), pa.array(score_),
                ],
                names=["block", "doc", "doc_id", "train", "n_tokens", "n_known", "base_score", "score"],
            )

    wanted = parts.where("kind in ('docs', 'sums')").select("block", "kind", "data")
    dealt = wanted.repartition("block").sortWithinPartitions("block", "kind")
    return map_arrow(dealt, added, "block long, doc long, doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double")


def query(spark: SparkSession, folder: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 7) == 2
    docs = table(spark, folder, "documents").select("doc_id", "text", (~held_out).alias("train"))
    out = score(docs)
    return out.scores.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(out.constants.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
