"""Mixing sources to target weights by iterative proportional fitting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import free_name, table
from tallyline.session import stash

DIMENSIONS = ("source", "lang", "topic")
_NAMES = [f"mix_{d}" for d in DIMENSIONS]
_ADDED = [*_NAMES, "mix_tokens", "mix_weight", "mix_probability", "mix_sampled"]
#: Up to so many cells, with names of so many characters, are fitted in memory; more stay a Spark table.
CELLS, NAME_CHARS = 100_000, 16 << 20
#: Without given targets, a share becomes its power by this, normalised: smaller groups gain.
FLATTEN = 0.8
#: The sample has this part of all tokens unless asked shares allow less.
KEEP = 0.8
SEED = 17
_UNKNOWN = "(none)"


def topic(text: Column) -> Column:
    """What a text mainly is, by its marks."""
    return (
        F.when(text.rlike(r"(?:\|[^|\n]*){6}"), "table")
        .when(text.rlike(r"(?i)\b(?:license|licence|copyright|warranty|rights reserved)\b"), "legal")
        .when(text.rlike(r"[{};][ \t]*\n.*[{};][ \t]*\n"), "code")
        .when(text.rlike(r"https?://|www\."), "web")
        .otherwise("prose")
    )


def described(docs: DataFrame, measured: Column | None = None) -> DataFrame:
    """``docs`` with what the mix goes by: ``mix_source``, ``mix_lang``, ``mix_topic`` (a null is a group of
    its own) and ``mix_tokens``, its words unless ``measured`` says otherwise."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    tokens = F.regexp_count(text, F.lit(r"\S+")) if measured is None else measured
    return docs.withColumns({
        "mix_source": F.coalesce(F.col("source").cast("string"), F.lit(_UNKNOWN)),
        "mix_lang": F.coalesce(F.col("lang").cast("string"), F.lit(_UNKNOWN)),
        "mix_topic": topic(text),
        "mix_tokens": tokens.cast("long"),
    })


def fit(tokens: np.ndarray, codes: Sequence[np.ndarray], wanted: Sequence[np.ndarray], most: float = 1.0, rounds: int = 500, tolerance: float = 1e-10, start: np.ndarray | None = None) -> np.ndarray:
    """Rates of cells, ``most`` at most, with which their ``tokens`` add up to ``wanted`` in each group of
    each axis; ``codes`` has the group of every cell, an axis at a time.

    A rate is a product of one factor a group, clipped. In turn, each axis gets the factors that meet its
    own sums: without clipping they are too small, and Newton's steps on a concave function come closer
    from below. Where axes contradict each other, rounds end when sums no longer improve; those of the
    last axis are then exact."""
    rate, errors = np.ones(len(tokens)) if start is None else start, []
    for _ in range(rounds):
        worst = 0.0
        for code, target in zip(codes, wanted, strict=True):
            n = len(target)
            now = np.bincount(code, tokens * np.minimum(rate, most), n)
            worst = max(worst, float(np.abs(now - target).max(initial=0.0)))
            now = np.bincount(code, tokens * rate, n)
            rate = rate * np.divide(target, now, out=np.zeros(n), where=now > 0)[code]
            for _ in range(100):
                clipped = rate >= most
                full = np.bincount(code, np.where(clipped, tokens * min(most, 1e300), 0.0), n)
                part = np.bincount(code, np.where(clipped, 0.0, tokens * rate), n)
                step = np.divide(target - full, part, out=np.ones(n), where=(part > 0) & (target > full))
                rate = np.minimum(rate * step[code], 1e200)
                if np.abs(step - 1).max(initial=0.0) < 1e-13:
                    break
        errors.append(worst)
        if worst <= tolerance * tokens.sum() or (len(errors) > 10 and worst > 0.99 * errors[-11]):
            break
    return np.minimum(rate, most)


def rake(cells: np.ndarray, targets: list[np.ndarray], rounds: int = 500, tolerance: float = 1e-10) -> np.ndarray:
    """Scale a table of weights along each axis in turn until its marginals are ``targets`` (each
    sums to one). Groups without weight keep none, and their targets go to the others in proportion."""
    codes = np.nonzero(cells)
    weights = cells[codes] / max(cells.sum(), 1e-300)
    wanted = []
    for code, target in zip(codes, targets, strict=True):
        t = np.where(np.bincount(code, weights, len(target)) > 0, target, 0.0)
        wanted.append(t / t.sum() if t.sum() else t)
    out = np.zeros(cells.shape)
    out[codes] = weights * fit(weights, codes, wanted, np.inf, rounds, tolerance)
    return out


def asked_shares(sizes: np.ndarray, names: list[str], asked: Mapping[str, float]) -> np.ndarray:
    """The given shares; values without one share what is left as they do now."""
    given = np.array([asked.get(g, np.nan) for g in names])
    free = np.isnan(given)
    given[free] = max(0.0, 1 - np.nansum(given)) * sizes[free] / max(sizes[free].sum(), 1e-300)
    given[sizes <= 0] = 0.0
    return given / max(given.sum(), 1e-300)


def flattened(sizes: np.ndarray, fixed: np.ndarray, size: float, flatten: float) -> np.ndarray:
    """Tokens of each group in a sample of ``size``: in proportion to a power of its tokens, but no more
    than it has. ``fixed`` groups keep their present share."""
    out = size * sizes / max(sizes.sum(), 1e-300)
    open_ = ~fixed & (sizes > 0)
    base, whole = np.where(open_, sizes.clip(1e-300) ** flatten, 0.0), np.zeros(len(sizes), bool)
    room = size - out[~open_].sum()
    while True:
        scale = max(0.0, room - sizes[whole].sum()) / max(base[open_ & ~whole].sum(), 1e-300)
        more = open_ & ~whole & (scale * base > sizes)
        if not more.any():
            return np.where(open_, np.where(whole, sizes, scale * base), out)
        whole |= more


def probabilities(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, flatten: float = FLATTEN, keep: float = KEEP) -> DataFrame:
    """The weight and sampling probability of each cell, by the names of ``described``.

    ``docs`` as ``described``. ``targets`` gives the wanted share of values for some of the dimensions;
    values it does not name share what is left as they do now. Dimensions without targets get their
    present shares, flattened; nulls keep theirs. Every value is a group, however many there are: token
    weights are summed per cell in Spark, and cells that do not fit the driver are fitted there too.

    The sample has ``keep`` of all tokens, in expectation, or as many as there can be with the shares that
    ``targets`` asks for. A group that flattening would give more tokens than it has is taken whole, and so
    is a cell; the others make up for it. So a small group, however small, changes the others by its own
    tokens only."""
    summed = stash(docs.groupBy(*_NAMES).agg(F.sum("mix_tokens").alias("tokens")).where("tokens > 0"), "mixing-cells")
    count, chars = summed.agg(F.count("*"), F.coalesce(F.sum(sum(F.length(n) for n in _NAMES)), F.lit(0))).first()
    if count > CELLS or chars > NAME_CHARS:
        return _many_rates(summed, targets or {}, flatten, keep)
    held = summed.collect()
    tokens = np.array([float(r["tokens"]) for r in held])
    groups = {d: sorted({r[n] for r in held}) for d, n in zip(DIMENSIONS, _NAMES, strict=True)}
    codes = {}
    for d, n in zip(DIMENSIONS, _NAMES, strict=True):
        at = {g: i for i, g in enumerate(groups[d])}
        codes[d] = np.array([at[r[n]] for r in held], dtype=np.int64)
    rate = _rates(tokens, codes, groups, targets or {}, flatten, keep)
    mean = float((tokens * rate).sum()) / max(tokens.sum(), 1e-300)
    rows = [(*(r[n] for n in _NAMES), float(p / max(mean, 1e-300)), float(p)) for r, p in zip(held, rate, strict=True)]
    return F.broadcast(docs.sparkSession.createDataFrame(rows, f"{', '.join(f'{n} string' for n in _NAMES)}, mix_weight double, mix_probability double"))


def _rates(tokens: np.ndarray, codes: Mapping[str, np.ndarray], groups: Mapping[str, list[str]], targets: Mapping[str, Mapping[str, float]], flatten: float, keep: float) -> np.ndarray:
    """The probability of each cell. Dimensions with targets come last, and then by
    themselves, so that theirs are exact where they do not contradict each other."""
    sizes = {d: np.bincount(codes[d], tokens, len(groups[d])) for d in DIMENSIONS}
    size, wanted = keep * float(tokens.sum()), {}
    shares = {d: asked_shares(sizes[d], groups[d], targets[d]) for d in DIMENSIONS if targets.get(d)}
    if shares:  # no cell can give more than it has
        alone = fit(tokens, [codes[d] for d in shares], [tokens.sum() * share for share in shares.values()], np.inf)
        size = min(size, float(tokens.sum()) / max(float(alone.max(initial=0.0)), 1e-300))
    order = sorted(DIMENSIONS, key=lambda d: d in shares)
    for d in order:
        fixed = np.array([g == _UNKNOWN for g in groups[d]], dtype=bool)
        wanted[d] = size * shares[d] if d in shares else flattened(sizes[d], fixed, size, flatten)
    rate = fit(tokens, [codes[d] for d in order], [wanted[d] for d in order])
    return fit(tokens, [codes[d] for d in shares], [wanted[d] for d in shares], start=rate) if len(shares) > 1 else rate


def _many_rates(summed: DataFrame, targets: Mapping[str, Mapping[str, float]], flatten: float, keep: float, rounds: int = 100, tolerance: float = 1e-8) -> DataFrame:
    """``probabilities`` of cells that stay in Spark: the sums of a step are a groupBy of one axis, and its
    factors are joined back. Each step is one of Newton's."""
    spark, total = summed.sparkSession, float(summed.agg(F.sum("tokens")).first()[0])
    sizes = {d: stash(summed.groupBy(n).agg(F.sum("tokens").cast("double").alias("x")), f"mixing-{d}") for d, n in zip(DIMENSIONS, _NAMES, strict=True)}
    size, shared = keep * total, {}
    for d, asked in targets.items():
        if not asked:
            continue
        given = spark.createDataFrame([(g, float(v)) for g, v in asked.items()], f"mix_{d} string, given double")
        named = sizes[d].join(F.broadcast(given), f"mix_{d}").select("x", "given").collect()  # as many as were asked for
        free, left = total - sum(r["x"] for r in named), max(0.0, 1 - sum(asked.values()))
        free = 0.0 if len(named) == sizes[d].count() else free
        whole = max(sum(r["given"] for r in named) + left * (free > 0), 1e-300)
        shared[d] = sizes[d].join(F.broadcast(given), f"mix_{d}", "left").withColumn(
            "share", F.coalesce(F.col("given"), F.lit(left / max(free, 1e-300)) * F.col("x")) / whole)
    order = sorted(DIMENSIONS, key=lambda d: d in shared)
    state = summed.withColumns({"tokens": F.col("tokens").cast("double"), "rate": F.lit(1.0)})
    for d in shared:
        state = state.join(shared[d].select(f"mix_{d}", (F.lit(total) * F.col("share")).alias(f"w_{d}")), f"mix_{d}")
    if shared:  # no cell can give more than it has
        state = stash(state, "mixing-state")
        size = min(size, total / max(_descended(state, [*shared], total, rounds, tolerance, float("inf")).agg(F.max("rate")).first()[0], 1e-300))
        state = state.withColumns({f"w_{d}": F.col(f"w_{d}") * F.lit(size / total) for d in shared})
    for d in order:
        if d not in shared:
            wanted = _many_flattened(sizes[d], f"mix_{d}", size, total, flatten).withColumnRenamed("w", f"w_{d}")
            state = state.join(wanted, f"mix_{d}")
    state = _descended(stash(state, "mixing-state"), order, total, rounds, tolerance)
    if len(shared) > 1:
        state = _descended(state, order[-len(shared) :], total, rounds, tolerance)
    chance = F.least("rate", F.lit(1.0))
    mean = state.agg(F.sum(F.col("tokens") * chance)).first()[0] / total
    return state.select(*_NAMES, (chance / max(mean, 1e-300)).alias("mix_weight"), chance.alias("mix_probability"))


def _descended(state: DataFrame, order: list[str], total: float, rounds: int, tolerance: float, most: float = 1.0) -> DataFrame:
    """``fit`` of a table: ``state`` with its column ``rate`` changed."""
    errors: list[float] = []
    for turn in range(rounds):
        worst = 0.0
        done = turn == rounds - 1 or (len(errors) > 0 and errors[-1] <= tolerance * total) or (len(errors) > 10 and errors[-1] > 0.99 * errors[-11])
        for d in [order[-1]] * 20 if done else order:
            clipped = F.col("rate") >= F.lit(most)
            sums = state.groupBy(f"mix_{d}").agg(
                F.max(f"w_{d}").alias("w"), F.sum(F.col("tokens") * F.col("rate")).alias("raw"),
                F.sum(F.when(clipped, F.col("tokens")).otherwise(0.0)).alias("full"), F.sum(F.when(clipped, 0.0).otherwise(F.col("tokens") * F.col("rate"))).alias("part"))
            factor = (
                F.when((F.col("part") > 0) & (F.col("w") > F.col("full")), (F.col("w") - F.col("full")) / F.col("part"))
                .when((F.col("raw") <= 0) | ((F.col("part") <= 0) & (F.col("w") >= F.col("full") * (1 - 1e-12))), 1.0)
                .otherwise(F.col("w") / F.col("raw"))
            )
            factors = stash(sums.select(f"mix_{d}", factor.alias("factor"), F.abs(F.col("full") + F.col("part") - F.col("w")).alias("error")), "mixing-factors")
            error = factors.agg(F.max("error")).first()[0]
            worst = max(worst, error)
            if done and error <= tolerance * total / 100:
                break
            columns = state.columns
            state = state.join(factors.drop("error"), f"mix_{d}").withColumn("rate", F.least(F.col("rate") * F.col("factor"), F.lit(1e200))).select(*columns)
            if done:
                state = stash(state, "mixing-state")
        if done:
            break
        state = stash(state, "mixing-state")
        errors.append(worst)
    return state


def _many_flattened(sizes: DataFrame, name: str, size: float, total: float, flatten: float) -> DataFrame:
    """``flattened`` of a table."""
    fixed, base = F.col(name) == _UNKNOWN, F.pow("x", F.lit(float(flatten)))
    scale = 0.0
    while True:
        whole = F.lit(scale) * base > F.col("x")
        full, part, kept = sizes.agg(*(F.coalesce(F.sum(F.when(on, value)), F.lit(0.0)) for on, value in ((~fixed & whole, F.col("x")), (~fixed & ~whole, base), (fixed, F.col("x"))))).first()
        now = max(0.0, size - size * kept / total - full) / part if part else scale
        if now <= scale * (1 + 1e-12):
            break
        scale = now
    return sizes.select(name, F.when(fixed, F.lit(size / total) * F.col("x")).otherwise(F.least(F.col("x"), F.lit(scale) * base)).alias("w"))


def _drawn(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None, flatten: float, seed: int, keep: float) -> DataFrame:
    """``mix_row``, the whole row of ``docs``, and the columns ``_ADDED``: inside a row no name can clash with ours."""
    draw = F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), F.col("text"), F.lit(seed)), 11) / F.lit(float(1 << 53))
    needed = docs.select(F.struct("*").alias("mix_row"), "doc_id", "text", "source", "lang")
    rows = described(needed).withColumn("mix_draw", draw).select("mix_row", *_NAMES, "mix_tokens", "mix_draw")
    joined = rows.join(probabilities(rows, targets, flatten, keep), _NAMES, "left")
    out = joined.withColumns({"mix_probability": F.coalesce("mix_probability", F.lit(0.0)), "mix_weight": F.coalesce("mix_weight", F.lit(0.0))})
    return out.withColumn("mix_sampled", F.col("mix_draw") < F.col("mix_probability")).select("mix_row", *_ADDED)


def mixed(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, flatten: float = FLATTEN, seed: int = SEED, keep: float = KEEP) -> DataFrame:
    """``docs`` (doc_id, text, source, lang and more) with ``mix_*`` columns and ``mix_sampled``.

    A document is in the sample if a hash of its id, text and ``seed`` falls below its cell's
    probability: sampling needs no coordination, gives the same rows again, and treats repeated
    rows alike. Documents without words weigh nothing; a cell of such documents only has
    probability 0, and they are not sampled from it. Texts of any length are counted whole. Nothing but sums per cell is
    shuffled, unless cells are too many for a broadcast. An empty table gives an empty result. Columns of
    ``docs`` are returned untouched; a new column whose name one of them has, in any case, gets underscores after it."""
    names = [F.col(n).alias(free_name(n, *docs.columns)) for n in _ADDED]
    return _drawn(docs, targets, flatten, seed, keep).select("mix_row.*", *names)


def sample(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, flatten: float = FLATTEN, seed: int = SEED, keep: float = KEEP) -> DataFrame:
    """The sampled documents, with their columns untouched, whatever their names; other cases as in :func:`mixed`."""
    return _drawn(docs, targets, flatten, seed, keep).where("mix_sampled").select("mix_row.*")


def query(spark: SparkSession, folder: str) -> DataFrame:
    out = mixed(table(spark, folder, "documents").select("doc_id", "text", "source", "lang"))
    return out.select(
        "doc_id", "source", "lang", F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("tokens"),
        F.col("mix_weight").alias("weight"), F.col("mix_probability").alias("probability"), F.col("mix_sampled").alias("sampled"),
    )
